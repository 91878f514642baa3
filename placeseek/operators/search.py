"""A batch of queries from request to response."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.operators import hits as hx
from placeseek.operators import lexical, semantic
from placeseek.operators.lexical import LexicalIndex
from placeseek.operators.semantic import PivotIndex
from placeseek.session import cut

LEXICAL_NAME = "bm25"
SEMANTIC_NAME = "faiss"
MODELS = (LEXICAL_NAME, SEMANTIC_NAME)


@dataclass(frozen=True)
class Collection:
    """What a search needs: posts, their index, their vectors and the query encoder.

    ``encode(queries)`` adds ``embedding`` to (query_id, query) rows. ``vectors`` are rows
    (id, embedding) or a pivot index of them. A post without a vector is an error, found
    when the collection is put together.
    """

    posts: DataFrame
    index: LexicalIndex
    vectors: DataFrame | PivotIndex
    encode: Callable[[DataFrame], DataFrame]

    def __post_init__(self) -> None:
        rows = self.vectors.rows if isinstance(self.vectors, PivotIndex) else self.vectors
        semantic.require_vectors(self.posts, rows)


def encode_queries(queries: DataFrame) -> DataFrame:
    return semantic.encode_hashed(queries, "query", ["query_id"])


def valid(queries: DataFrame) -> DataFrame:
    return queries.filter(F.col("model").isin(*MODELS))


def rejected(queries: DataFrame) -> DataFrame:
    """Requests whose model is not one of the two."""
    return queries.filter(~F.coalesce(F.col("model").isin(*MODELS), F.lit(False)))


def _greatest_k(queries: DataFrame) -> int:
    return int(queries.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0])


def _within_k(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    wanted = queries.select("query_id", "k")
    return ranked.join(wanted, "query_id").filter(F.col("rank") <= F.col("k")).drop("k")


def lexical_hits(collection: Collection, queries: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Flat result records of the queries, by text; with ``allowed(id)`` among those posts only."""
    k = _greatest_k(queries)
    among = None if allowed is None else allowed.select(F.col("id").alias("doc_id"))
    ranked = _within_k(lexical.search(collection.index, queries, k, allowed=among), queries)
    return hx.shaped(hx.attach_posts(ranked, collection.posts), hx.LEXICAL)


def semantic_hits(collection: Collection, queries: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Flat result records of the queries, by vector; blank queries find nothing."""
    asked = queries.filter(~tx.is_blank(F.col("query")))
    k = _greatest_k(queries)
    found = semantic.nearest(collection.vectors, collection.encode(asked), k, allowed)
    ranked = _within_k(found, queries)
    return hx.shaped(hx.attach_posts(ranked, collection.posts, key="id"), hx.SEMANTIC)


def search(collection: Collection, queries: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Route each query to its model and return all flat records together.

    ``allowed(id)``, such as the ids of ``rerank.restricted`` posts, limits what is ranked, so a
    query has k hits whenever k posts pass.
    """
    branches = []
    for name, run in ((LEXICAL_NAME, lexical_hits), (SEMANTIC_NAME, semantic_hits)):
        asked = queries.filter(F.col("model") == name)
        if not asked.isEmpty():
            branches.append(run(collection, asked, allowed).withColumn("model", F.lit(name)))
    if not branches:
        empty = queries.limit(0).withColumn("k", F.lit(1))
        return lexical_hits(collection, empty).withColumn("model", F.lit(LEXICAL_NAME))
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch, allowMissingColumns=True)
    return out


def responses(
    collection: Collection,
    queries: DataFrame,
    generate: Callable[[Column], Column] | None = None,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """One row per valid query: text, parameters, ranked records, explanations.

    Lists hold the k records of one query. ``queries`` has ``query_id``, ``query``,
    ``model``, ``k`` and ``explain``.
    """
    asked = valid(queries)
    flat = cut(search(collection, asked, allowed))
    nested = None
    for name, shown in ((LEXICAL_NAME, hx.LEXICAL), (SEMANTIC_NAME, hx.SEMANTIC)):
        part = hx.records(flat.filter(F.col("model") == name), shown)
        nested = part if nested is None else nested.unionByName(part)
    record = F.struct(*[c for c in nested.columns if c not in ("query_id", "rank")])
    lists = nested.groupBy("query_id").agg(
        F.transform(
            F.array_sort(
                F.collect_list(F.struct("rank", record.alias("r"))),
                lambda a, b: F.signum(a["rank"] - b["rank"]).cast("int"),
            ),
            lambda e: e["r"],
        ).alias("results")
    )
    told = (
        hx.explained(flat, asked, generate)
        .groupBy("query_id")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "explanation"))),
                lambda e: e["explanation"],
            ).alias("explanations")
        )
    )
    params = F.struct(
        F.struct("model", "k").alias("retrieval"), F.col("model").alias("model_used")
    )
    empty = F.array().cast(lists.schema["results"].dataType)
    return (
        asked.join(lists, "query_id", "left")
        .join(told, "query_id", "left")
        .select(
            "query_id",
            "query",
            params.alias("params"),
            F.coalesce("results", empty).alias("results"),
            F.coalesce("explanations", F.array().cast("array<string>")).alias("explanations"),
        )
    )
