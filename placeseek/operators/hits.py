"""From ranked ids to result records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.functions import kernels
from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.session import cut
from placeseek.sizing import fits, join_checked, localised, one_of

LEXICAL = "BM25"
SEMANTIC = "FAISS"
SHOWN_DIGITS = 4
EXPLAINED = 3
# Fixed value: shown where no explanation could be made.
FALLBACK = "Explanation unavailable."
UNKNOWN_PLACE = "Unknown"
# Up to this many ranked ids are pushed down to the scan of the posts.
PUSHED_IDS = 2000


def attach_posts(hits: DataFrame, posts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Join ranked ids back to their posts.

    A ranking is small, so it is computed once and kept as a local table; one too large
    for that is stored. A short list of ids also becomes a filter on the scan, so that a
    post table sorted by id is not read in full to fetch a few bodies.
    """
    settled, rows = localised(hits.withColumnRenamed(key, "id"))
    if rows is None:
        settled = cut(settled)
    else:
        ids = sorted({r["id"] for r in rows})
        if len(ids) <= PUSHED_IDS:
            posts = posts.filter(one_of("id", ids))
    small = rows is not None or fits(settled)
    if small and (rows is None or len(ids) > PUSHED_IDS):
        # Goes below the joins that the posts are made of, so that only bodies of hits are shuffled by them.
        posts = posts.join(F.broadcast(settled.select("id").distinct()), "id", "left_semi")
    return join_checked(posts, settled, "id", spread="page_url", small_fits=small)


def snippets(description: Column, shown: Column) -> Column:
    """Non-empty description and preview, at most two."""
    both = F.array(F.coalesce(description, F.lit("")), F.coalesce(shown, F.lit("")))
    return F.slice(F.filter(both, lambda s: s != ""), 1, 2)


def shaped(found: DataFrame, model: str) -> DataFrame:
    """Flat result record for hits joined to posts.

    ``found`` holds the post columns, ``query_id``, ``rank`` and ``score`` (lexical) or
    ``distance`` (semantic).
    """
    lexical = model == LEXICAL
    place = F.col("location_name")
    shown = tx.preview(F.col("content"))

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    value = vx.half_up(F.col("score" if lexical else "distance"), SHOWN_DIGITS)
    return found.select(
        "query_id",
        "rank",
        "id",
        (F.coalesce(place, F.lit(UNKNOWN_PLACE)) if lexical else place).alias("destination"),
        F.coalesce(vx.country(place), F.lit("")).alias("country"),
        vx.coordinate(F.col("latitude"), zero_is_missing=lexical).alias("lat"),
        vx.coordinate(F.col("longitude"), zero_is_missing=lexical).alias("lon"),
        (value if lexical else F.lit(None).cast("double")).alias("score"),
        (F.lit(None).cast("double") if lexical else value).alias("distance"),
        snippets(F.col("page_description"), shown).alias("snippets"),
        text("page_title").alias("page_title"),
        text("page_url").alias("page_url"),
        text("blog_url").alias("blog_url"),
        text("page_author").alias("author"),
        text("page_description").alias("description"),
        shown.alias("content_preview"),
        text("content").alias("full_content"),
    ).filter(F.col("destination").isNotNull())


def why(model: str) -> Column:
    """Where a hit comes from, as a nested record."""
    return F.struct(
        F.lit(model).alias("model"), "page_title", "page_url", "blog_url", "author"
    )


def records(shaped_hits: DataFrame, model: str) -> DataFrame:
    """Nested result records with the two fields that ranking itself leaves empty."""
    cues = F.lit(None).cast("map<string,map<string,int>>")
    return shaped_hits.select(
        "query_id", "rank", "id", "destination", "country", "lat", "lon", "score", "distance",
        F.lit(None).cast("double").alias("trend_delta"),
        F.coalesce(cues, F.create_map().cast("map<string,map<string,int>>")).alias("context_cues"),
        "snippets",
        "full_content",
        why(model).alias("why"),
    )


# -- explanations --------------------------------------------------------------------


def prompt(query: Column, post: Column) -> Column:
    """Instruction text for a text generator; holds the query and the whole post."""
    return F.trim(
        F.concat(
            F.lit("Explain to a traveller why this place fits their request.\nRequest: "),
            F.coalesce(query, F.lit("")),
            F.lit("\nArticle: "),
            F.coalesce(post, F.lit("")),
            F.lit("\nName the place exactly. Use at most 8 sentences."),
        )
    )


def extract_answer(prompt_text: Column) -> Column:
    """Default generator: the opening of the article inside the prompt."""
    return tx.snippet(F.regexp_extract(prompt_text, r"(?s)\nArticle: (.*)\nName the place", 1))


def generator(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """A generator for :func:`explained` of a function from prompt to text, which may fail for some prompts."""
    return F.pandas_udf(kernels.guarded(function), T.StringType())


def explained(
    shaped_hits: DataFrame,
    queries: DataFrame,
    generate: Callable[[Column], Column] | None = None,
    top: int = EXPLAINED,
) -> DataFrame:
    """(query_id, rank, id, explanation) for the first hits of queries that ask for it.

    ``queries`` has ``query_id``, ``query`` and ``explain``. ``generate`` maps a prompt
    column to a text column, usually a pandas UDF around a model; a null answer stands
    for a failed call and becomes a fixed text. :func:`generator` makes one of a function.
    """
    asked = queries.filter(F.col("explain")).select("query_id", "query")
    first = shaped_hits.filter(F.col("rank") <= top).join(asked, "query_id")
    answer = (generate or extract_answer)(prompt(F.col("query"), F.col("full_content")))
    return first.select(
        "query_id", "rank", "id", F.coalesce(answer, F.lit(FALLBACK)).alias("explanation")
    )


# -- summaries of a result set --------------------------------------------------------


def numbered(hits: DataFrame) -> DataFrame:
    """Rank from 1 within each query, best score or smallest distance first."""
    order = Window.partitionBy("query_id").orderBy(
        F.desc_nulls_last("score"), F.asc_nulls_last("distance"), F.asc("id")
    )
    return hits.withColumn("rank", F.row_number().over(order))


def summary(hits: DataFrame) -> DataFrame:
    """Hits, mean score and mean distance per query; the latter only if any is positive."""
    return hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.avg("score").alias("mean_score"),
        F.when(F.sum("distance") > 0, F.avg("distance")).alias("mean_distance"),
    )


def mappable(hits: DataFrame) -> DataFrame:
    """Hits that have both coordinates, with one value: score, else distance."""
    return hits.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "query_id", "id", "destination", "country", "lat", "lon",
        F.coalesce("score", "distance").alias("value"),
        F.col("score").isNull().alias("is_distance"),
    )


def coloured(points: DataFrame) -> DataFrame:
    """Place each value between the least and greatest of its query, as red and green.

    A query has at most k points, so the window holds k rows.
    """
    same = Window.partitionBy("query_id")
    low, high = F.min("value").over(same), F.max("value").over(same)
    spread = F.when(high != low, high - low).otherwise(1.0)
    share = (F.col("value") - low) / spread
    placed = points.withColumn("share", F.when(F.col("is_distance"), 1 - share).otherwise(share))
    return placed.withColumn("red", vx.ramp(1 - F.col("share"))).withColumn(
        "green", vx.ramp(F.col("share"))
    )
