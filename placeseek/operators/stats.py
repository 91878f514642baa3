"""Corpus statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.session import stored
from placeseek.sizing import join_checked

QUARTILES = (0.25, 0.5, 0.75)
# Of the sketch that brackets a quantile, and distinct values of a bracket that are looked at one by one.
ACCURACY = 2_000
LEFT_VALUES = 10_000


def overview(posts: DataFrame) -> DataFrame:
    """One row: posts, and distinct locations, blogs and authors (nulls not counted)."""
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.countDistinct("location_name").alias("unique_locations"),
        F.countDistinct("blog_url").alias("unique_blogs"),
        F.countDistinct("page_author").alias("unique_authors"),
    )


def places(posts: DataFrame) -> DataFrame:
    """Posts per place with known coordinates."""
    return (
        posts.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("location_name", "latitude", "longitude")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def payload(posts: DataFrame) -> DataFrame:
    """Overview numbers next to every place row, as one flat table."""
    totals = overview(posts)
    # A global aggregate is one row, so it can stand as a single value.
    whole = totals.select(F.struct(*totals.columns)).scalar()
    placed = places(posts)
    return placed.withColumn("_o", whole).select(*placed.columns, "_o.*")


def with_count_class(grouped: DataFrame, count: str = "cnt") -> DataFrame:
    return grouped.withColumn("count_class", vx.count_class(F.col(count)))


def map_centre(grouped: DataFrame) -> DataFrame:
    return grouped.agg(
        F.avg("latitude").alias("centre_lat"), F.avg("longitude").alias("centre_lon")
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent values; equal counts in value order."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc(column))
        .limit(n)
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null) for every column, in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.col(c).alias("non_null"),
            )
            for c in df.columns
        ]
    )
    return counts.select(F.inline(rows))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, and the most frequent value with its frequency.

    Values are counted by a 256-bit digest, so whole bodies are no shuffle keys. Of the
    most frequent ones only the least is looked up, as a minimum inside the tasks.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    values = df.select(F.inline(cells)).filter(F.col("value").isNotNull())
    keyed = values.withColumn("digest", F.sha2("value", 256))
    counted = stored(keyed.groupBy("name", "digest").agg(F.count(F.lit(1)).alias("n")), "counted")
    totals = counted.groupBy("name").agg(
        F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq")
    )  # a row per column
    # Where no value repeats, all are equally frequent and none needs to be looked up.
    leading = counted.filter("n > 1").join(F.broadcast(totals), "name").filter("n = freq").select("name", "digest")
    once = [r.name for r in totals.filter("freq = 1").collect()]
    tops = join_checked(keyed.filter(~F.col("name").isin(once)), leading, ["name", "digest"], "left_semi", spread="value")
    top = tops.select("name", "value").unionByName(values.filter(F.col("name").isin(once)))
    return totals.join(top.groupBy("name").agg(F.min("value").alias("top")), "name").select(
        "name", "cnt", "unique", "top", "freq"
    )


def _sketch(value: Column, share: float, margin: float) -> Column:
    """[value surely at or before the share, value near it, value surely at or after it], by a mergeable sketch."""
    near = [min(1.0, max(0.0, share + side * margin)) for side in (-1, 0, 1)]
    return F.percentile_approx(value, near, ACCURACY)


def _sketches(columns: Sequence[str], probabilities: Sequence[float]) -> list[Column]:
    # The sketch may be off by a share of 1 / ACCURACY, and ranks are a little off the probability.
    return [_sketch(F.col(c), p, 3 / ACCURACY) for c in columns for p in probabilities]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], ends: Sequence | None = None
) -> dict[str, list[float]]:
    """Interpolated quantiles of numeric columns, exactly, without sorting them.

    A sketch brackets each rank and guesses its value; the next pass counts what lies below, inside and
    at the guess, which either is the value or cuts the bracket. Brackets with at most
    ``LEFT_VALUES`` distinct values are counted value by value. Every pass is one aggregation over the
    columns; a bracket shrinks to a few thousandths each time, and a very frequent value is found as a
    guess. ``ends`` are counts, minima, maxima and sketches of the columns, where a first pass has them.
    """
    m = len(columns)
    if ends is None:
        parts = [f(c) for f in (F.count, F.min, F.max) for c in columns] + _sketches(columns, probabilities)
        ends = df.agg(*[part.alias(f"_{k}") for k, part in enumerate(parts)]).first()
    found: dict[tuple[int, int], float] = {}
    # (column, rank) to (low, high, values below, inside, distinct inside), and to a sketch.
    open_to: dict[tuple[int, int], tuple] = {}
    guesses: dict[tuple[int, int], Sequence[float]] = {}
    for i in range(m):
        for k, p in enumerate(probabilities if ends[i] else ()):
            for rank in (math.floor(p * (ends[i] - 1)), math.ceil(p * (ends[i] - 1))):
                open_to[i, rank] = ends[m + i], ends[2 * m + i], 0, ends[i], ends[i]
                guesses[i, rank] = ends[3 * m + i * len(probabilities) + k]

    def inside(i: int, low: float, high: float) -> Column:
        return F.col(columns[i]).between(low, high)

    while open_to:
        for key, (low, high, *_) in list(open_to.items()):
            if low == high:
                found[key] = low
                del open_to[key]
        small = {key: v for key, v in open_to.items() if min(v[3:]) <= LEFT_VALUES}
        if small:
            cells = [
                F.struct(F.lit(k).alias("k"), F.when(inside(i, low, high), F.col(columns[i])).alias("v"))
                for k, ((i, _), (low, high, *_)) in enumerate(small.items())
            ]
            rows = df.select(F.inline(F.array(*cells))).filter("v is not null").groupBy("k", "v").count().collect()
            for k, (key, (_, _, below, *_)) in enumerate(small.items()):
                for row in sorted((r for r in rows if r.k == k), key=lambda r: r.v):
                    below += row["count"]
                    if key[1] < below:
                        found[key] = row.v
                        break
                del open_to[key]
        if not open_to:
            break
        if not guesses:
            sketches = [
                _sketch(F.when(inside(i, low, high), F.col(columns[i])), (rank - below + 0.5) / n, 2 / ACCURACY)
                for (i, rank), (low, high, below, n, _) in open_to.items()
            ]
            row = df.agg(*[s.alias(f"_{k}") for k, s in enumerate(sketches)]).first()
            guesses = dict(zip(open_to, row, strict=True))
        counts = []
        for key in open_to:
            value, (low, guess, high) = F.col(columns[key[0]]), guesses[key]
            held = F.when(inside(key[0], low, high), value)
            counts += [
                F.count_if(value < low), F.count(held), F.approx_count_distinct(held),
                F.count_if(value < guess), F.count_if(value == guess),
            ]
        totals = df.agg(*[c.alias(f"_{k}") for k, c in enumerate(counts)]).first()
        for k, key in enumerate(list(open_to)):
            (low, guess, high), (below, n, distinct, less, same) = guesses[key], totals[5 * k : 5 * k + 5]
            if less <= key[1] < less + same:
                found[key] = guess
                del open_to[key]
            elif key[1] < less:
                open_to[key] = low, math.nextafter(guess, -math.inf), below, less - below, distinct
            else:
                upto = less + same
                open_to[key] = math.nextafter(guess, math.inf), high, upto, n - (upto - below), distinct
        guesses = {}
    out: dict[str, list[float]] = {c: [] for c in columns}
    for i, c in enumerate(columns):
        for p in probabilities:
            exact = p * (ends[i] - 1)
            if not ends[i]:
                out[c].append(None)
                continue
            low, high = found[i, math.floor(exact)], found[i, math.ceil(exact)]
            out[c].append(low + (exact - math.floor(exact)) * (high - low))
    return out


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    ``df`` is read several times, a few numbers a row: store columns that are costly to work out.
    """
    numeric = df.select(*[vx.without_nan(F.col(c).cast("double")).alias(c) for c in columns])
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"_{i}_cnt"),
            F.avg(c).alias(f"_{i}_mean"),
            F.stddev_samp(c).alias(f"_{i}_std"),
            F.min(c).alias(f"_{i}_min"),
            F.max(c).alias(f"_{i}_max"),
        ]
    sketches = [s.alias(f"_near_{k}") for k, s in enumerate(_sketches(columns, QUARTILES))]
    moments = numeric.agg(*aggregates, *sketches).first()
    ends = [moments[f"_{i}_{part}"] for part in ("cnt", "min", "max") for i in range(len(columns))]
    ends += [moments[f"_near_{k}"] for k in range(len(sketches))]
    quartiles = exact_quantiles(numeric, columns, QUARTILES, ends)
    rows = [
        (c, *(moments[f"_{i}_{part}"] for part in ("cnt", "mean", "std", "min")), *quartiles[c], moments[f"_{i}_max"])
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "name string, cnt long, mean double, std double, min_value double, q25 double, q50 double, q75 double, max_value double",
    )


def with_word_count(posts: DataFrame) -> DataFrame:
    return posts.withColumn("word_count", tx.word_count(F.col("content")))


def with_text_lengths(posts: DataFrame) -> DataFrame:
    return posts.withColumn("title_len", F.char_length("page_title")).withColumn(
        "desc_len", F.char_length("page_description")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, cnt) for non-empty bins of equal width; the last one includes the maximum."""
    value = F.col(column).cast("double")
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    both = ends.select(F.struct("low", "high")).scalar()
    low, high = both["low"], both["high"]
    width = (high - low) / bins
    place = F.when(width > 0, F.least(F.floor((value - low) / width), F.lit(bins - 1))).otherwise(0)
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(first, second, corr) for every pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"{a}|{b}").alias("corr"))
            for a, b in pairs
        ]
    )
    return row.select(F.inline(cells))


def with_continent(posts: DataFrame) -> DataFrame:
    return posts.withColumn("continent", vx.continent(F.col("latitude"), F.col("longitude")))


def per_continent(posts: DataFrame) -> DataFrame:
    return (
        with_continent(posts)
        .groupBy("continent")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("continent"))
    )


def top_words(posts: DataFrame, n: int, stop_words: Sequence[str] = ()) -> DataFrame:
    """Most frequent words of the bodies, without the given ones."""
    words = posts.select(F.explode_outer(tx.tokens(F.col("content"))).alias("word"))
    kept = words.filter(F.col("word").isNotNull() & ~F.col("word").isin(list(stop_words)))
    return top_values(kept, "word", n)


def tone(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, tone): mean weight of the words found in ``lexicon(term, weight)``, else 0.

    Words are counted inside each post first; lookups then see each word once.
    """
    bags = tx.with_term_bag(posts, F.col("content"), ["id"])
    words = bags.select("id", F.inline_outer("bag"))
    scored = join_checked(words, lexicon, "term", how="left", spread="id")
    weight = F.col("weight").cast("double")
    hits = F.sum(F.when(weight.isNotNull(), F.col("tf")))
    return scored.groupBy("id").agg(
        F.coalesce(F.sum(weight * F.col("tf")) / hits, F.lit(0.0)).alias("tone")
    )


def coverage_points(posts: DataFrame) -> DataFrame:
    """Points of the coverage map, merged to whole degrees, with their number."""
    return (
        posts.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy(F.round("latitude").alias("lat"), F.round("longitude").alias("lon"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


