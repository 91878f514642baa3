"""Signals beside the text score, and merging of ranked lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.operators.topk import top_k
from placeseek.sizing import join_checked

FUSION_OFFSET = 60

# Default cues of a place off the usual routes; callers pass their own.
CUES = {
    "positive": ("hidden gem", "locals only", "underrated", "off the beaten path"),
    "negative": ("tourist trap", "overcrowded", "overrated"),
}


def _plain_words(text: Column) -> Column:
    """Tokens between single spaces, with a space at both ends."""
    return F.concat(F.lit(" "), F.array_join(tx.tokens(text), "  "), F.lit(" "))


def phrase_count(words: Column, phrase: str) -> Column:
    """Occurrences of a phrase as whole words in the form of ``_plain_words``."""
    needle = " " + "  ".join(phrase.lower().split()) + " "
    size = F.char_length(words) - F.char_length(F.replace(words, F.lit(needle), F.lit("")))
    return (size / len(needle)).cast("int")


def cue_counts(posts: DataFrame, cues: Mapping[str, Sequence[str]] = CUES) -> DataFrame:
    """(id, polarity, cue, n) for cues that occur; ``cues`` maps polarity to phrases.

    The phrase lists are parameters of the job, so each is a constant in the plan and a
    post is read once for all of them.
    """
    words = posts.select("id", _plain_words(F.col("content")).alias("_words"))
    cells = [
        F.struct(
            F.lit(polarity).alias("polarity"),
            F.lit(cue).alias("cue"),
            phrase_count(F.col("_words"), cue).alias("n"),
        )
        for polarity, phrases in cues.items()
        for cue in phrases
    ]
    found = words.select("id", F.filter(F.array(*cells), lambda c: c["n"] > 0).alias("_found"))
    return found.select("id", F.inline_outer("_found")).filter(F.col("cue").isNotNull())


def cue_map(counts: DataFrame) -> DataFrame:
    """(id, context_cues): polarity to cue to count. Groups hold one post's cues."""
    inner = counts.groupBy("id", "polarity").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("cue", "n")))).alias("_by_cue")
    )
    return inner.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("polarity", "_by_cue"))).alias("context_cues")
    )


def attribute_match(posts: DataFrame, tags: Mapping[str, Sequence[str]]) -> DataFrame:
    """(id, attribute_share): share of the asked tags with a term in the post."""
    words = posts.select("id", F.array_distinct(tx.tokens(F.col("content"))).alias("_w"))
    hit = F.lit(0)
    for terms in tags.values():
        hit = hit + F.arrays_overlap("_w", F.array(*[F.lit(t) for t in terms])).cast("int")
    return words.select("id", (hit / max(1, len(tags))).alias("attribute_share"))


def query_overlap(found: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, overlap): distinct query words in the post over distinct query words.

    ``found`` holds hits joined to the bodies of their posts.
    """
    asked = queries.select("query_id", F.array_distinct(tx.tokens(F.col("query"))).alias("_q"))
    bodies = found.select("query_id", "id", F.array_distinct(tx.tokens(F.col("content"))).alias("_w"))
    pairs = join_checked(bodies, asked, "query_id", spread="id")
    return pairs.select(
        "query_id", "id",
        F.when(
            F.size("_q") > 0, F.size(F.array_intersect("_q", "_w")) / F.size("_q")
        ).otherwise(0.0).alias("overlap"),
    )


def damped(hits: DataFrame, posts: DataFrame, value: str = "score") -> DataFrame:
    """Divide the score by 1 + ln(posts at the same place)."""
    popularity = posts.groupBy("location_name").agg(F.count(F.lit(1)).alias("_at_place"))
    joined = join_checked(
        hits, popularity.filter(F.col("location_name").isNotNull()), "location_name",
        how="left", spread="id",
    )
    return joined.withColumn(
        "damped", F.col(value) / (1 + F.log(F.coalesce(F.col("_at_place"), F.lit(1)).cast("double")))
    ).drop("_at_place")


def fused(lexical: DataFrame, semantic: DataFrame, k: int) -> DataFrame:
    """Reciprocal rank fusion of two (query_id, rank, id) lists: sum of 1 / (60 + rank)."""
    left = lexical.select("query_id", "id", F.col("rank").alias("lexical_rank"))
    right = semantic.select("query_id", "id", F.col("rank").alias("semantic_rank"))

    def share(name: str) -> Column:
        return F.coalesce(1.0 / (FUSION_OFFSET + F.col(name)), F.lit(0.0))

    merged = left.join(right, ["query_id", "id"], "full_outer").withColumn(
        "fused", F.round(share("lexical_rank") + share("semantic_rank"), 8)
    )
    return top_k(merged, ["query_id"], [F.desc("fused"), F.asc("id")], k, "id")


def restricted(
    posts: DataFrame,
    countries: Sequence[str] | None = None,
    continents: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
) -> DataFrame:
    """Posts of the given countries, continents or containing one of the tags."""
    out = posts
    if countries is not None:
        out = out.filter(vx.country(F.col("location_name")).isin(list(countries)))
    if continents is not None:
        out = out.filter(
            vx.continent(F.col("latitude"), F.col("longitude")).isin(list(continents))
        )
    if tags is not None:
        out = out.filter(tx.has_token(F.col("content"), tags))
    return out


def chunks(posts: DataFrame, size: int, stride: int) -> DataFrame:
    """(id, chunk, text): windows of ``size`` words, ``stride`` apart, covering every word."""
    words = posts.select("id", F.split(tx.squeeze(F.coalesce("content", F.lit(""))), " ").alias("_w"))
    last = F.greatest(F.ceil((F.size("_w") - size) / stride), F.lit(0)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.array_join(F.slice("_w", i * stride + 1, size), " "),
    )
    # The filter comes after the windows are made, or every text would be split for it once more.
    windows = F.when(F.get("_w", F.lit(0)) != "", parts)
    numbered = words.select("id", windows.alias("_parts"))
    return numbered.select("id", F.posexplode_outer("_parts").alias("chunk", "text")).filter("chunk is not null")


def best_per_place(hits: DataFrame, value: str = "score") -> DataFrame:
    """Best hit of each place within a query, by a running maximum."""
    best = F.max(F.struct(F.col(value).alias("v"), (-F.col("id")).alias("i"))).alias("_best")
    return (
        hits.groupBy("query_id", "location_name")
        .agg(best, F.count(F.lit(1)).alias("posts"))
        .select(
            "query_id", "location_name",
            (-F.col("_best.i")).alias("id"), F.col("_best.v").alias(value), "posts",
        )
    )


def with_signals(
    found: DataFrame,
    posts: DataFrame,
    queries: DataFrame,
    cues: Mapping[str, Sequence[str]] = CUES,
    tags: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``found`` (query_id, id, content, location_name) with the signals of its posts.

    ``cue_balance`` positive minus negative cues, ``attribute_share`` of the asked tags,
    ``overlap`` with the words of the query, and ``damping`` = 1 / (1 + ln(posts at the place)). Only the
    found posts are read for the first three.
    """
    bodies = found.select("id", "content").dropDuplicates(["id"])
    sign = F.when(F.col("polarity") == "positive", F.col("n")).otherwise(-F.col("n"))
    balance = cue_counts(bodies, cues).groupBy("id").agg(F.sum(sign).alias("cue_balance"))
    shares = attribute_match(bodies, tags or {})
    overlap = query_overlap(found, queries)
    placed = damped(found.withColumn("_one", F.lit(1.0)), posts, "_one").withColumnRenamed("damped", "damping")
    known = placed.join(balance, "id", "left").join(shares, "id", "left").join(overlap, ["query_id", "id"], "left")
    return known.drop("_one").withColumn("cue_balance", F.coalesce("cue_balance", F.lit(0)))


def reordered(
    hits: DataFrame, weights: Mapping[str, float], damping: Column | None = None, digits: int = 8
) -> DataFrame:
    """Weighted sum of signal columns, damped, as ``final``, with a new rank per query."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    if damping is not None:
        total = total * damping
    order = Window.partitionBy("query_id").orderBy(F.desc("final"), F.asc("id"))
    return hits.withColumn("final", F.round(total, digits)).withColumn(
        "final_rank", F.row_number().over(order)
    )


def activity_change(
    events: DataFrame, time: str, key: str, window: str, late: str | None = None
) -> DataFrame:
    """(key, window_start, n, trend_delta): activity and its change since the last window.

    Every event adds one to its own window and takes one from the next, so the change is
    a plain sum and the same expression serves batch and stream. A window without activity
    gives a row when the one before had some: a fall to nothing. In a batch, windows
    that begin after the newest event are not over and give none. ``late`` bounds how late
    events of a stream may come, counted from the newest event.
    """
    at = F.col(time) if late is None else F.col(time).cast("timestamp")
    own = F.struct(at.alias("_t"), F.lit(1).alias("_n"), F.lit(1).alias("_d"))
    later = F.struct(
        (at + F.expr(f"INTERVAL {window}")).alias("_t"),
        F.lit(0).alias("_n"),
        F.lit(-1).alias("_d"),
    )
    marks = events.select(F.col(key), F.inline(F.array(own, later)))
    if late is not None:
        # The newest mark lies a window after the newest event, so the wait is a window longer.
        marks = marks.withWatermark("_t", f"{late} {window}")
    grouped = marks.groupBy(key, F.window("_t", window).alias("_window"))
    changes = grouped.agg(F.sum("_n").alias("n"), F.sum("_d").alias("trend_delta")).select(
        key, F.col("_window.start").alias("window_start"), "n", "trend_delta"
    )
    if late is None:
        changes = changes.filter(F.col("window_start") <= events.agg(F.max(time)).scalar())
    return changes
