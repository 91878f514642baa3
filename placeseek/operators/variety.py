"""One place under several spellings, and variety among the hits of a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.functions import kernels
from placeseek.functions import text as tx
from placeseek.operators.topk import top_k
from placeseek.session import stored
from placeseek.sizing import join_checked

# Names below this length must be equal but for accents and case.
LEAST_LETTERS = 5
CANDIDATES = 50

_fold_batch = F.pandas_udf(kernels.fold, T.StringType())


def folded(name: Column) -> Column:
    """Lower case without accents, white space evened out; only names beyond ASCII go to Python."""
    plain = tx.squeeze(F.lower(name))
    beyond = F.when(F.octet_length(name) != F.char_length(name), plain)
    return F.coalesce(_fold_batch(beyond), plain)


def _one_edit(names: DataFrame) -> DataFrame:
    """(a, b) edges between folded names one insertion, deletion or substitution apart.

    Names that lose the same rest with the letter at one place differ in that letter only, so each
    such set is a star around its least name. A name that equals the rest of another
    is that name less a letter. No set of names is ever paired with itself.
    """
    long = names.filter(F.char_length("name") >= LEAST_LETTERS)
    cuts = long.select("name", F.explode(F.sequence(F.lit(1), F.char_length("name"))).alias("place"))
    rest = F.concat(
        F.substring(F.col("name"), F.lit(1), F.col("place") - 1),
        F.substring(F.col("name"), F.col("place") + 1, F.char_length("name")),
    )
    cuts = stored(cuts.select("name", "place", rest.alias("rest")), "cuts")
    least = cuts.groupBy("place", "rest").agg(F.min("name").alias("least"), F.count(F.lit(1)).alias("n"))
    same = cuts.join(least.filter("n > 1"), ["place", "rest"]).select(F.col("name").alias("a"), F.col("least").alias("b"))
    shorter = cuts.select("rest", "name").distinct().join(long.select(F.col("name").alias("rest")), "rest")
    return same.unionByName(shorter.select(F.col("name").alias("a"), F.col("rest").alias("b"))).filter("a <> b")


def _connected(names: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, place): the least name reachable from each; rounds grow with the logarithm of the longest way."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(names.select("name", F.col("name").alias("place")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("name", "b"), "b").groupBy("a").agg(F.min("place").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "name"), "name", "left").select(
            "name", "place", F.least("place", F.coalesce("near", "place")).alias("next")
        )
        # A label points to a name that may have a better one itself.
        via = lower.select(F.col("name").alias("next"), F.col("next").alias("via"))
        jumped = lower.join(via, "next", "left").select("name", "place", F.least("next", F.coalesce("via", "next")).alias("next"))
        settled = stored(jumped, "labels")
        labels = settled.select("name", F.col("next").alias("place"))
        if settled.filter("place <> next").isEmpty():
            return labels


def places_alike(names: DataFrame, name: str = "location_name") -> DataFrame:
    """(name, place): every distinct spelling and the folded name that stands for its place.

    Spellings are one place if a chain of them leads from one to the other, each equal to the next but
    for case, accents and white space, or one edit away. Null names are left out.
    """
    spelled = stored(
        names.select(F.col(name)).filter(F.col(name).isNotNull()).distinct().withColumn("_folded", folded(F.col(name))),
        "spelled",
    )
    distinct = spelled.select(F.col("_folded").alias("name")).distinct()
    groups = _connected(distinct, _one_edit(distinct))
    return spelled.join(groups.withColumnRenamed("name", "_folded"), "_folded").select(name, "place")


def best_per_alike_place(hits: DataFrame, alike: DataFrame, value: str = "score") -> DataFrame:
    """(query_id, place, id, value, posts): the best hit of each place, whatever its spelling."""
    placed = join_checked(hits, alike, "location_name", spread="id")
    best = F.max(F.struct(F.col(value).alias("v"), (-F.col("id")).alias("i"))).alias("_best")
    return placed.groupBy("query_id", "place").agg(best, F.count(F.lit(1)).alias("posts")).select(
        "query_id", "place", (-F.col("_best.i")).alias("id"), F.col("_best.v").alias(value), "posts"
    )


def varied(hits: DataFrame, k: int, share: float = 0.7, value: str = "score", candidates: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, id): k hits per query by marginal relevance.

    ``hits`` has (query_id, id, value, embedding, place). One hit after the other is taken: the one with the
    greatest ``share`` * relevance - (1 - ``share``) * likeness to what was taken, where relevance
    is the value over the greatest one, likeness the cosine of the vectors, and 1 for the same place. Only the
    ``candidates`` best hits of a query are looked at, which is part of the method and bounds the group.
    Ties go to the lower id.
    """
    best = top_k(hits, ["query_id"], [F.desc(value), F.asc("id")], candidates, "id", rank="_from")
    rows = best.select("query_id", "id", F.col(value).cast("double").alias("value"), "embedding", "place")
    return rows.groupBy("query_id").applyInPandas(kernels.marginal(k, share), "query_id long, rank int, id long")
