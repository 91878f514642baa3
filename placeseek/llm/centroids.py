"""Centroid clustering with vector approximations.

Components are scaled to integers, so all distances and sums are exact. Every vector is stored twice: whole, and as an
approximation of ``BITS`` bits a dimension, the number of the cell its component lies in.
Cell borders come from a bounded sample (about ``SAMPLE`` vectors, by the hash of their row); the outer
cells reach to the least and greatest component of all vectors, so the sample only affects speed.

A round reads the approximations alone. A table of squared distances from each cell to each centroid, added up over
the dimensions, gives an interval per centroid. A vector belongs to a centroid whose interval ends before
all others begin; it is fetched whole only where intervals overlap. The sums of the clusters are kept
and corrected by vectors that change their cluster, so of the decided vectors only those are
fetched. What was decided before follows from the centroids before, so a round holds no state.
The whole vectors are stored in buckets by row, so that the rows to fetch are sent to
them: the vectors themselves are shuffled once, when they are stored.

Null ids, null vectors, vectors of another length and vectors with null or non-finite components
take no part. A repeated vec_id is a vector per row. With fewer vectors than ``k``, each is a
centroid. An empty table gives no rows. Other columns are not read. A component of ``LIMIT`` or
more after scaling is an error, as squared distances would leave a long.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.session import parallelism, stored, work_path

DIM = 64
SCALE = 1024
K = 8
ROUNDS = 10
SEED = 3
BITS = 4
SAMPLE = 16_384
LIMIT = 1 << 27
# Rows whose tables of distances are looked up together.
STEP = 2_048


def usable(vector: Column, dim: int) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & sound


def integers(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, vector): components floor(scale * x) of the usable vectors as 32-bit integers."""
    wide = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"), dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            scaled = np.floor(values * float(scale))
            if len(scaled) and not np.abs(scaled).max() < LIMIT:
                raise ValueError(f"a component is not below {LIMIT / scale}: squared distances leave a long")
            data = [v.tobytes() for v in scaled.astype("<i4")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["vec_id", "vector"])

    whole = rows.mapInArrow(run, "vec_id long, vector binary")
    return whole.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")


def matrix(column: pa.Array, dtype: str = "<i4") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1 if len(column) else 0)


@contextmanager
def bucketed(rows: DataFrame, shards: int) -> Iterator[DataFrame]:
    """``rows`` stored under the shared folder in buckets by ``row``.

    Buckets need a table in the session's catalog; it is taken out at the end, and the files stay.
    """
    spark = rows.sparkSession
    name = f"vectors_{uuid.uuid4().hex}"
    dealt = rows.repartition(shards, "row").sortWithinPartitions("row")
    written = dealt.write.bucketBy(shards, "row").sortBy("row").option("path", work_path(spark, "vectors"))
    written.saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def extent(whole: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest component of each dimension: one row per task to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(0))
                ends = values.min(axis=0), values.max(axis=0)
                low = ends[0] if low is None else np.minimum(low, ends[0])
                high = ends[1] if high is None else np.maximum(high, ends[1])
        if low is not None:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(len(low)), "low": low, "high": high})

    rows = (
        whole.select("vector").mapInArrow(run, "dim long, low int, high int")
        .groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    )
    return np.array([r.low for r in rows], dtype=np.int64), np.array([r.high for r in rows], dtype=np.int64)


def borders(whole: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) component of every cell, dimensions x cells, both included."""
    low, high = extent(whole)
    size = 1 << 40
    share = min(1.0, sample / whole.count())
    picked = whole.filter(F.pmod(F.xxhash64("row"), F.lit(size)) <= int(share * size)).select("vector").toArrow()
    values = np.sort(matrix(picked.column(0).combine_chunks()), axis=0).astype(np.int64)
    values = values if len(values) else low[None, :]
    cells = 1 << bits
    at = np.arange(1, cells) * len(values) // cells
    # A cell begins at its border and ends before the next; empty cells hold no vector.
    begins = np.concatenate([low[:, None], np.clip(values[at].T, low[:, None], high[:, None])], axis=1)
    ends = np.concatenate([begins[:, 1:] - 1, high[:, None]], axis=1)
    return begins, np.maximum(ends, begins)


def cells_of(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Number of the cell of every component: the last one that begins at or before it."""
    out = np.zeros(values.shape, dtype=np.uint8)
    for cell in range(1, begins.shape[1]):
        out += values >= begins[None, :, cell]
    return out


def packed(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of cell numbers, ``bits`` bits each."""
    single = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits :]
    return np.packbits(single.reshape(len(cells), -1), axis=1)


def unpacked(data: np.ndarray, dim: int, bits: int) -> np.ndarray:
    single = np.unpackbits(data, axis=1, count=dim * bits).reshape(len(data), dim, bits)
    return (single << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)


class Tables:
    """Squared distance from the cells of each dimension to some centroids: least and greatest."""

    def __init__(self, begins: np.ndarray, ends: np.ndarray, centroids: np.ndarray):
        to_low = begins[:, :, None] - centroids.T[:, None, :]
        to_high = ends[:, :, None] - centroids.T[:, None, :]
        inside = (to_low <= 0) & (to_high >= 0)
        near = np.minimum(np.abs(to_low), np.abs(to_high))
        self.least = np.where(inside, 0, near) ** 2
        self.most = np.maximum(np.abs(to_low), np.abs(to_high)) ** 2

    def decided(self, cells: np.ndarray) -> np.ndarray:
        """Centroid of each row of cells, -1 where the intervals overlap.

        Equal distances go to the smaller number, so against larger numbers touching is enough.
        """
        dims = np.arange(cells.shape[1])[None, :]
        out = np.empty(len(cells), dtype=np.int64)
        for at in range(0, len(cells), STEP):
            part = cells[at : at + STEP]
            low, high = (t[dims, part].sum(axis=1) for t in (self.least, self.most))
            best = high.argmin(axis=1)
            bound = high[np.arange(len(part)), best][:, None]
            number = np.arange(low.shape[1])[None, :]
            apart = np.where(number < best[:, None], low > bound, low >= bound) | (number == best[:, None])
            out[at : at + STEP] = np.where(apart.all(axis=1), best, -1)
        return out


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid, from whole vectors."""
    gaps = np.stack([((values - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1)
    best = gaps.argmin(axis=1)
    return best, gaps[np.arange(len(values)), best]


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors of the ``k`` smallest hashes of seed and id, in this order; equal ids by their vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.select(digest.alias("h"), F.hex("vector").alias("x"), "vector").orderBy("h", "x").limit(k).collect()
    return np.array([np.frombuffer(r.vector, dtype="<i4") for r in rows], dtype=np.int64)


def changes(rows: DataFrame, before: np.ndarray | None, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) that the clusters gain by whole vectors ``rows`` (vector).

    A vector is added to its present cluster and taken from the one before; sums are added up in the tasks
    and then by cluster and dimension.
    """
    k, dim = now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column(0)).astype(np.int64)
            for centroids, sign in ((now, 1), (before, -1)):
                if centroids is not None:
                    own, _ = nearest(values, centroids)
                    np.add.at(sums, own, sign * values)
                    np.add.at(n, own, sign)
        moved = np.flatnonzero(sums.any(axis=1) | (n != 0))
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": np.repeat(moved, dim + 1),
                "dim": np.tile(np.arange(dim + 1), len(moved)),
                "v": np.concatenate([sums, n[:, None]], axis=1)[moved].ravel(),
            }
        )

    out = np.zeros((k, dim + 1), dtype=object)
    added = rows.select("vector").mapInArrow(run, "cluster long, dim long, v long").groupBy("cluster", "dim")
    for row in added.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out[row.cluster, row.dim] = int(row.v)
    return out[:, :dim], out[:, dim]


def to_fetch(cells: DataFrame, ends: tuple, before: np.ndarray, now: np.ndarray, bits: int) -> DataFrame:
    """(row) of the vectors that two sets of centroids leave undecided or give to other clusters."""
    dim = now.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Tables(*ends, c) for c in (before, now)]
        for batch in batches:
            if batch.num_rows:
                part = unpacked(matrix(batch.column(1), "u1"), dim, bits)
                old, new = (t.decided(part) for t in tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array((old < 0) | (new < 0) | (old != new)))], names=["row"]
                )

    return cells.select("row", "cells").mapInArrow(run, "row long")


def clustered(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED,
    bits: int = BITS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector.

    ``centroid`` holds the components of the vector's final centroid.
    """
    with bucketed(integers(vectors, dim, scale), parallelism(vectors.sparkSession)) as whole:
        centroids = first_centroids(whole, k, seed)
        if len(centroids):
            centroids = _settled(whole, centroids, rounds, bits)
        return _assigned(whole, centroids)


def _settled(whole: DataFrame, centroids: np.ndarray, rounds: int, bits: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds."""
    ends = borders(whole, bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = packed(cells_of(matrix(batch.column(1)), ends[0]), bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([d.tobytes() for d in data], pa.binary())], names=["row", "cells"]
                )

    cells = stored(whole.select("row", "vector").mapInArrow(approximate, "row long, cells binary"), "cells")
    before, sums, n = None, 0, 0
    for _ in range(rounds):
        rows = whole
        if before is not None:
            wanted = to_fetch(cells, ends, before, centroids, bits)
            rows = whole.join(wanted.hint("merge"), "row", "left_semi")
        gained, more = changes(rows, before, centroids)
        sums, n = sums + gained, n + more
        # Whole numbers of any size, rounded down; an empty cluster keeps its centroid.
        after = [[s // c for s in row] if c else old for row, c, old in zip(sums, n, centroids.tolist(), strict=True)]
        before, centroids = centroids, np.array(after, dtype=np.int64)
        if (before == centroids).all():
            break  # further rounds would change nothing
    return centroids


def _assigned(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Final cluster and distance of every vector; this needs every whole vector once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, gaps = nearest(matrix(batch.column(1)).astype(np.int64), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best.astype(np.int32)), pa.array(gaps)],
                    names=["vec_id", "cluster", "distance"],
                )

    done = stored(whole.select("vec_id", "vector").mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    total = done.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row a cluster
    inertia = sum(r.cluster_inertia for r in total)
    known = done.sparkSession.createDataFrame(
        [(r.cluster, r.cluster_inertia, inertia, centroids[r.cluster].tolist()) for r in total],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return done.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(centroid: Column) -> Column:
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
