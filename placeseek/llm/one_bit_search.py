"""Nearest neighbours by inner product from randomly rotated one-bit codes.

Vectors are scaled to unit length and rotated at random; the signs are the code (a bit per
dimension), with two correction scalars: the length and the inner product of the unit
vector with its code. From the codes the inner product with a query is estimated with an
error bound. A row is reranked on its original vector only when its upper bound reaches the
query's k-th best lower bound in the block of rows, or what is known as its k-th best score.

Rows are dealt into groups of bounded size, the queries into blocks; every block meets every
group (a stated query set against all rows), each task keeps k rows per query, and the k
best of all groups remain. Scores are exact inner products in double precision.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, as
query or candidate. Only vectors of equal length are compared. A repeated vec_id is a
candidate once per row, never for its own id. Ties go to the smaller vec_id. Empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
GROUP_ROWS = 8_192
QUERY_BLOCK = 16_384
# Queries whose bounds are held at once.
QUERY_STEP = 512
SEED = 7
# Errors beyond this many standard deviations of the estimate are not expected.
BOUND = 3.0


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vector, length) of each row; squares of very large or small components stay in range."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    # Twice, as the inverse of the smallest numbers is out of range.
    scaled = vectors / most
    inner = np.sqrt((scaled**2).sum(axis=1, keepdims=True))
    with np.errstate(over="ignore"):
        return scaled / inner, (inner * most)[:, 0]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, length, inner product of unit vector and code) of each row."""
    unit, length = units(vectors)
    turned = unit.astype(np.float32) @ turn
    fit = np.abs(turned).sum(axis=1) / np.sqrt(np.float32(vectors.shape[1]))
    return np.packbits(turned >= 0, axis=1), length, fit.astype(np.float64)


def estimates(bits: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray, turn: np.ndarray):
    """(estimate, error bound) of the inner product with unit queries, queries x rows.

    Products of unit vectors and codes are in single precision; lengths come in as doubles.
    """
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = units(queries)[0].astype(np.float32) @ turn
    rough = (turned @ signs.T).astype(np.float64) / np.sqrt(dim)
    spread = np.sqrt(np.maximum(0.0, 1 - fit**2)) / fit * BOUND / np.sqrt(max(1, dim - 1))
    # Rounding in single precision counts as error, too.
    return rough * (length / fit), np.broadcast_to((spread + 1e-5) * length, rough.shape)


def nearest_in_group(ids, vectors, bits, length, fit, query_ids, queries, k: int, step: int = 1024):
    """(query position, row position, score) of the k best rows of each query."""
    turn = rotation(vectors.shape[1])
    size = units(queries)[1]
    floor = np.full(len(queries), -np.inf)
    kept: list[list[np.ndarray]] = [[] for _ in queries]
    scores: list[list[np.ndarray]] = [[] for _ in queries]
    for begin in range(0, len(ids), step):
        part = slice(begin, begin + step)
        rough, error = estimates(bits[part], length[part], fit[part], queries, turn)
        own = query_ids[:, None] == ids[None, part]
        low = np.where(own, -np.inf, rough - error)
        if low.shape[1] > k:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        # What cannot be compared is looked at.
        worth = ~(rough + error < floor[:, None]) & ~own
        for q in np.flatnonzero(worth.any(axis=1)).tolist():
            at = np.flatnonzero(worth[q]) + begin
            # Row by row, so that equal vectors get equal sums.
            exact = (vectors[at] * queries[q]).sum(axis=1)
            kept[q].append(at)
            scores[q].append(exact)
            known = np.concatenate(scores[q])
            if len(known) >= k:
                best = np.lexsort((ids[np.concatenate(kept[q])], -known))[:k]
                rows = np.concatenate(kept[q])[best]
                kept[q], scores[q] = [rows], [known[best]]
                # The k-th score in units of the query's length, and a little less for rounding.
                least = known[best[-1]] / size[q]
                floor[q] = np.fmax(floor[q], least - 1e-9 * abs(least))
    for q in range(len(queries)):
        if kept[q]:
            rows, known = np.concatenate(kept[q]), np.concatenate(scores[q])
            best = np.lexsort((ids[rows], -known))[:k]
            yield from ((q, int(r), float(s)) for r, s in zip(rows[best], known[best], strict=True))


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0)


def index(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, bits, length, fit): every usable row with its code."""
    rows = vectors.filter("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    rows = rows.filter(usable(F.col("vector"))).withColumn("dim", F.size("vector"))

    def add(batches):
        deal = TaskContext.get().partitionId() << 36
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                bits, length, fit = encode(np.stack(part["vector"].to_numpy()), rotation(int(dim)))
                deals = deal + np.arange(len(part))
                deal += len(part)
                yield part.assign(bits=[b.tobytes() for b in bits], length=length, fit=fit, deal=deals)

    return rows.mapInPandas(
        add, "vec_id long, vector array<double>, dim int, bits binary, length double, fit double, deal long"
    )


def _searching(k: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, vectors = left["vec_id"].to_numpy(), np.stack(left["vector"].to_numpy())
            bits = np.frombuffer(b"".join(left["bits"]), dtype=np.uint8).reshape(len(left), -1)
            query_ids, queries = right["vec_id"].to_numpy(), np.stack(right["vector"].to_numpy())
            for at in range(0, len(query_ids), QUERY_STEP):
                part = slice(at, at + QUERY_STEP)
                found = nearest_in_group(
                    ids, vectors, bits, left["length"].to_numpy(), left["fit"].to_numpy(), query_ids[part], queries[part], k
                )
                out += [(query_ids[at + q], ids[r], s) for q, r, s in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return search


def nearest(
    indexed: DataFrame, queries: DataFrame, k: int = K, group_rows: int = GROUP_ROWS, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each of ``queries`` (vec_id, vector, dim).

    ``indexed`` and ``queries`` are stored rows: they are counted and then read.
    """
    groups = max(1, -(-indexed.count() // group_rows))
    blocks = max(1, -(-queries.count() // query_block))
    # Dealt by the row's number, as many rows may share an id or a vector.
    rows = indexed.withColumn("_group", F.pmod(F.xxhash64("deal"), F.lit(groups)))
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.select("vec_id", "vector", "dim").withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    keys = ["_group", "_block", "dim"]
    found = (
        rows.groupBy(*keys).cogroup(asked.groupBy(*keys))
        .applyInPandas(_searching(k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
