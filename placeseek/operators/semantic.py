"""Text vectors: encoding, pooling and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.functions import kernels
from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.operators.positions import with_running_total
from placeseek.operators.topk import top_k
from placeseek.session import stored
from placeseek.sizing import join_checked, localised, one_of

# Query vectors that are worked on together.
QUERY_BLOCK = 1024
PIVOTS = 256
UNIT_ROWS = 1024
UNITS = 65_536
# Up to this many units become a filter of the scan.
PUSHED_UNITS = 2_000
DEFAULT_DIM = 64


class MissingVectors(ValueError):
    """Some posts have no stored vector."""


# -- encoding ---------------------------------------------------------------------


def encode_with(
    df: DataFrame,
    text: str,
    make_predict_fn: Callable,
    out: str = "embedding",
    batch_size: int = 32,
) -> DataFrame:
    """Encode a text column with a user's model, loaded once per Python worker.

    ``make_predict_fn()`` returns a function from an array of strings to a 2-d float
    array; null texts arrive as empty ones. Any limit on input length is the model's.
    """
    predict = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return df.withColumn(out, predict(tx.encoder_text(F.col(text))))


def encode_hashed(df: DataFrame, text: str, keys: list[str], dim: int = DEFAULT_DIM) -> DataFrame:
    """Encoder that needs no model: signed term counts by hashed slot, unit length.

    The whole text is used. Words are cut by built-in functions; an Arrow batch of them is hashed,
    each distinct word once, and added up. Nothing is shuffled.
    """
    counted = F.arrow_udf(kernels.signed_counts(dim), T.ArrayType(T.DoubleType()))
    raw = df.select(*keys, counted(tx.tokens(F.col(text))).alias("_dense"))
    return raw.select(*keys, vx.unit(F.col("_dense")).alias("embedding"))


def mean_pool(df: DataFrame, keys: list[str], vector: str, mask: Column) -> DataFrame:
    """Masked mean of a group of vectors: sum(v * m) / max(sum(m), 1e-9), per slot.

    Each task adds up its own rows first, so a group of any size arrives as one
    partial sum per slot and task.
    """
    slots = df.select(*keys, mask.cast("double").alias("_m"), F.posexplode_outer(vector))
    pooled = (
        slots.filter(F.col("pos").isNotNull())
        .groupBy(*keys, "pos")
        .agg(
            (F.sum(F.col("col").cast("double") * F.col("_m")) / F.greatest(F.sum("_m"), F.lit(1e-9))).alias("v")
        )
    )
    # One group now has as many rows as the vector has slots.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return pooled.groupBy(*keys).agg(
        F.transform(ordered, lambda e: e["v"]).alias("embedding")
    )


# -- joining vectors to posts -------------------------------------------------------


def missing_vectors(posts: DataFrame, vectors: DataFrame) -> DataFrame:
    return posts.select("id").join(vectors.select("id"), "id", "left_anti")


def require_vectors(posts: DataFrame, vectors: DataFrame) -> None:
    """Fail when a post has no vector."""
    lost = missing_vectors(posts, vectors).limit(5).collect()
    if lost:
        raise MissingVectors(f"no vector for posts {[r[0] for r in lost]}")


def with_vectors(posts: DataFrame, vectors: DataFrame, strict: bool = True) -> DataFrame:
    """Posts with their vectors; a post without one is an error when ``strict``."""
    if strict:
        require_vectors(posts, vectors)
    return posts.join(vectors, "id")


# -- exact nearest neighbours -------------------------------------------------------


@dataclass(frozen=True)
class PivotIndex:
    """Vectors in order of (nearest pivot, distance to it), cut into units.

    rows    (unit, id, embedding), stored in order of unit
    pivots  some of the vectors, at most ``PIVOTS``
    units   (unit, pivot, low, high, n, reach): distances to the pivot and greatest squared
            length inside a unit; at most ``UNITS`` + ``PIVOTS`` rows, whatever the corpus
    """

    rows: DataFrame
    pivots: np.ndarray
    units: pd.DataFrame


def build_pivots(
    vectors: DataFrame, path: str, pivots: int = PIVOTS, unit_rows: int = UNIT_ROWS
) -> PivotIndex:
    """Write ``vectors(id, embedding)`` in order of pivots under ``path``; null vectors are left out.

    One range shuffle puts the vectors in order. Copies of a vector may fill many units; a unit is
    a stretch of rows, which tasks read in batches, so its size is no matter of memory.
    """
    spark = vectors.sparkSession
    sound = vectors.select(F.col("id").cast("long").alias("id"), "embedding").filter("embedding is not null")
    n = sound.count()
    # About ``pivots`` of the vectors, by the hash of their id.
    share = max(1, int(min(1.0, pivots / max(1, n)) * 2**40))
    picked = sound.filter(F.pmod(F.xxhash64("id"), F.lit(2**40)) < share).limit(2 * pivots).collect()
    if not picked:
        picked = sound.limit(1).collect()
    chosen = np.array([r["embedding"] for r in picked], dtype=np.float64)
    placed = sound.mapInArrow(
        kernels.nearest_pivot(chosen), "id long, embedding array<double>, pivot int, gap double, reach double"
    )
    # Stored, as borders of ranges are found in a pass of its own.
    placed = stored(placed, "placed")
    ordered = with_running_total(placed, ["pivot", "gap", "id"], F.lit(1), "_row")
    size = max(unit_rows, -(-n // UNITS))
    stretch = F.floor((F.col("_row") - 1) / size).cast("int")
    # A stretch over the border of two pivots is two units.
    unit = stretch * F.lit(len(chosen) + 1) + F.col("pivot")
    numbered = ordered.withColumn("unit", unit.cast("long"))
    numbered.select("unit", "id", "embedding", "pivot", "gap", "reach").write.parquet(f"{path}/vectors")
    rows = spark.read.schema(
        "unit long, id long, embedding array<double>, pivot int, gap double, reach double"
    ).parquet(f"{path}/vectors")
    units = rows.groupBy("unit", "pivot").agg(
        F.min("gap").alias("low"), F.max("gap").alias("high"), F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach")
    )
    return PivotIndex(rows.select("unit", "id", "embedding"), chosen, units.orderBy("unit").toPandas())


def _query_blocks(queries: DataFrame, rows: list | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query ids and vectors in blocks of about ``QUERY_BLOCK`` rows; one block at a time is in the driver."""
    count = queries.count() if rows is None else len(rows)
    parts = 1 if count <= QUERY_BLOCK else -(-2 * count // QUERY_BLOCK)
    for part in range(parts):
        if rows is not None and parts == 1:
            block = rows
        else:
            block = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part).collect()
        block = [r for r in block if r["embedding"] is not None]
        if block:
            ids = np.array([r["query_id"] for r in block], dtype=np.int64)
            yield ids, np.array([r["embedding"] for r in block], dtype=np.float64)


FOUND = "query_id long, id long, distance double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return top_k(found, ["query_id"], [F.asc("distance"), F.asc("id")], k, "id").select("query_id", "rank", "id", "distance")


def _nothing(spark) -> DataFrame:
    return spark.createDataFrame([], "query_id long, rank int, id long, distance double")


def nearest(
    vectors: DataFrame | PivotIndex, queries: DataFrame, k: int, allowed: DataFrame | None = None
) -> DataFrame:
    """Exact k nearest ``vectors(id, embedding)`` per ``queries(query_id, embedding)``.

    The value is the squared Euclidean distance; ties go to the lower id. With ``allowed(id)`` only
    those vectors are ranked. Query blocks reach the tasks through Spark's broadcast storage and the
    vectors are scanned once for all of them; pairs are never rows of a DataFrame. A
    :class:`PivotIndex` skips the units that cannot hold a hit.
    """
    spark = queries.sparkSession
    asked, small = localised(
        queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")), QUERY_BLOCK
    )
    if small is None:
        asked = stored(asked, "asked")
    if isinstance(vectors, PivotIndex):
        return _nearest_by_pivots(vectors, asked, small, k, allowed)
    rows = vectors.select(F.col("id").cast("long"), "embedding").filter(F.col("embedding").isNotNull())
    if allowed is not None:
        rows = join_checked(rows, allowed.select("id").distinct(), "id", "left_semi")
    blocks = [spark.sparkContext.broadcast(b) for b in _query_blocks(asked, small)]
    if not blocks:
        return _nothing(spark)
    return _ranked(rows.mapInArrow(kernels.nearest_in_batches(blocks, k), FOUND), k)


def _looks(index: PivotIndex, units: pd.DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, unit): the units nearest to each query by their bound that hold k vectors together."""
    known = asked.sparkSession.sparkContext.broadcast((index.pivots, units))
    return asked.filter("embedding is not null").mapInArrow(kernels.first_units(known, k), "query_id long, unit long")


def _nearest_by_pivots(
    index: PivotIndex, asked: DataFrame, small: list | None, k: int, allowed: DataFrame | None
) -> DataFrame:
    spark = asked.sparkSession
    rows, units = index.rows, index.units
    if allowed is not None:
        # Stored, as the filter may be costly and its rows are counted before they are joined.
        kept = join_checked(rows, stored(allowed.select("id").distinct(), "ids"), "id", "left_semi")
        rows = stored(kept.select("unit", "id", "embedding"), "allowed")
        held = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).toPandas()  # no more than units
        units = units.drop(columns="n").merge(held, on="unit")
    if not len(units) or not len(index.pivots):
        return _nothing(spark)
    firsts = _looks(index, units, asked, k)
    if small is None:
        firsts = stored(firsts, "looks")
    blocks, looked = [], set()
    for ids, matrix in _query_blocks(asked, small):
        mine = (firsts if small is not None else firsts.filter(one_of("query_id", ids.tolist()))).toPandas()
        looked.update(mine["unit"].tolist())  # no more than units
        blocks.append(spark.sparkContext.broadcast((ids, matrix, mine, None)))
    if not blocks:
        return _nothing(spark)
    meta = spark.sparkContext.broadcast((index.pivots, units))
    some = rows.filter(one_of("unit", sorted(looked))) if len(looked) <= PUSHED_UNITS else rows
    near = _ranked(some.mapInArrow(kernels.nearest_in_units(blocks, meta, k, True), FOUND), k)
    near, _ = localised(near) if small is not None else (near, None)
    if small is None:
        near = stored(near, "near")
    last = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("floor"))
    floors = last.filter(F.col("n") >= k).select("query_id", "floor").toPandas()  # two numbers a query
    closer = []
    for held in blocks:
        ids, matrix, mine, _ = held.value
        floor = pd.Series(np.inf, index=ids)
        known = floors[floors["query_id"].isin(ids)]
        floor.loc[known["query_id"].to_numpy()] = known["floor"].to_numpy()
        closer.append(spark.sparkContext.broadcast((ids, matrix, mine, floor.to_numpy())))
    needed = sorted({u for held in closer for u in kernels.units_within(held.value, index.pivots, units)})
    rest = rows.filter(one_of("unit", needed)) if len(needed) <= PUSHED_UNITS else rows
    found = near.select("query_id", "id", "distance")
    if needed:
        more = rest.mapInArrow(kernels.nearest_in_units(closer, meta, k, False), FOUND)
        found = found.unionByName(more)
    return _ranked(found, k)


def skipped_share(index: PivotIndex, queries: DataFrame, k: int) -> float:
    """Share of the (query, unit) pairs that a search does not look at."""
    spark = queries.sparkSession
    last = nearest(index, queries, k).groupBy("query_id").agg(F.max("distance").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")).join(
        last.filter(F.col("n") >= k), "query_id"
    )
    known = spark.sparkContext.broadcast((index.pivots, index.units))
    seen = floors.select("query_id", "embedding", "floor").mapInArrow(kernels.seen_units(known), "seen long, units long")
    row = seen.agg(F.sum("seen"), F.sum("units")).first()
    return 1.0 - row[0] / row[1] if row[1] else 0.0
