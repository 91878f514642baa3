"""Benchmark decontamination by template windows, in DataFrame operations.

Words are canonicalised: numbers, units behind a number, and names (capitalised words
inside a sentence) become typed placeholders, the rest loses case and marks.
Windows of ``WINDOW`` canonical words are hashed; those of the documents meet those of the
benchmark in a hash join. A document holds an item when at least ``COVERAGE`` of the item's
windows are found, and when the slots are filled consistently: along the diagonal with the
most windows, each value of the item stands for one value in the document. Changed values
are allowed, so questions with other numbers or names are found as well.

Items of fewer than ``WINDOW`` words and windows with fewer than ``LITERALS`` words that are
no placeholders are not searched for. Null and empty texts hold nothing. Repeated rows give
one result row; empty tables give none. Other columns are not read. The benchmark's windows
are broadcast only when they fit the checked size; otherwise both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.session import stored
from placeseek.sizing import fits

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
CONSISTENT = 0.75

NUMBER, NAME, UNIT = "\u27e8d\u27e9", "\u27e8n\u27e9", "\u27e8u\u27e9"
# Runs of white space and ASCII marks part words.
BORDER = r"[\s\p{Punct}]+"
TRIMMED = " \t\r\n\f\x0b!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# A capitalised word that is not all capitals, behind a word that ends no sentence.
NAMED = r"(?<=[^.!?:\s]\s)[\p{Punct}]*+\p{Lu}\p{L}*\p{Ll}\p{L}*"
# Units of measure.
UNITS = (
    "mm cm m km inch inches ft feet yard yards mile miles mg g kg t lb lbs oz ml l litre litres liter liters "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent degrees dollars euros cents pounds kmh mph w kw kwh v a hz gb mb kb"
).split()


def words(text: Column) -> Column:
    """Words as they stand."""
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(TRIMMED)), BORDER)


def with_canonical(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with a column of canonical words, one for each of :func:`words`."""
    named = F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), NAMED, NAME))
    df = df.withColumn(name, named)
    numbered = F.regexp_replace(name, r"(?<![^\s\p{Punct}])[0-9][^\s\p{Punct}]*", NUMBER)
    listed = "|".join(UNITS)
    units = F.regexp_replace(
        numbered, rf"(?<={NUMBER}[\s\p{{Punct}}]{{1,3}})(?:{listed})(?![^\s\p{{Punct}}])", UNIT
    )
    whole = F.when(F.col(name).rlike("[0-9]"), units).otherwise(F.col(name))
    return df.withColumn(name, F.split(F.btrim(whole, F.lit(TRIMMED)), BORDER))


def with_windows(df: DataFrame, words: str, window: int = WINDOW) -> DataFrame:
    """``df`` with ``__h``: hashes of all windows of a column of words; none below ``window`` words.

    Windows double by joining halves. Each level is a projection of its own, as its column
    is used several times in the next. Explode them with an outer form: the filter that the
    inner form adds would repeat all levels below.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    df, width = df.withColumn("__h", F.transform(words, lambda x: F.xxhash64(x))), 1
    while width < window:
        count = F.greatest(F.size("__h") - width, F.lit(0))
        df = df.withColumn("__first", F.slice("__h", F.lit(1), count))
        df = df.withColumn("__second", F.slice("__h", F.lit(width + 1), F.size("__first")))
        df = df.withColumn("__h", F.zip_with("__first", "__second", lambda a, b: F.xxhash64(a, b)))
        width *= 2
    return df.drop("__first", "__second")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """(window, item_id, at, n_windows)."""
    items = benchmark.filter("item_id is not null").dropDuplicates(["item_id"]).select("item_id", "text")
    items = with_canonical(items, "text", "w")
    rows = with_windows(items, "w", window).select("item_id", "w", F.posexplode_outer("__h").alias("at", "window"))
    held = F.filter(F.slice("w", F.col("at") + 1, window), lambda x: ~x.isin(NUMBER, NAME, UNIT))
    rows = rows.filter("window is not null").filter(F.size(held) >= literals).select("window", "item_id", "at")
    total = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_windows"))
    return rows.join(total, "item_id")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    consistent: float = CONSISTENT,
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found, n_slots, n_changed, coverage, consistency)."""
    sought = stored(benchmark_windows(benchmark, window), "benchmark_windows")
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = with_canonical(texts, "text", "w").select("doc_id", "w")
    windows = with_windows(cut, "w", window).select("doc_id", F.posexplode_outer("__h").alias("pos", "window"))
    small = fits(sought)
    windows = windows.filter("window is not null")
    hits = windows.join(F.broadcast(sought) if small else sought, "window").select(
        "doc_id", "item_id", "n_windows", "at", (F.col("pos") - F.col("at")).alias("shift")
    )
    # One row per document, item, diagonal and place, however often rows repeat.
    hits = stored(hits.distinct(), "window_hits")
    held = hits.groupBy("doc_id", "item_id", "n_windows").agg(F.countDistinct("at").alias("n_found"))
    held = held.filter(F.col("n_found") >= coverage * F.col("n_windows"))
    diagonal = hits.groupBy("doc_id", "item_id", "shift").agg(
        F.count(F.lit(1)).alias("k"), F.min("at").alias("lo"), F.max("at").alias("hi")
    )
    best = diagonal.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("k", (-F.col("shift")).alias("back"), "lo", "hi")).alias("b")
    )
    found = stored(
        held.join(best, ["doc_id", "item_id"]).select(
            "doc_id", "item_id", "n_windows", "n_found",
            (-F.col("b.back")).alias("shift"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi"),
        ),
        "held",
    )
    slots = slot_values(found, texts, benchmark, window)
    joined = found.join(slots, ["doc_id", "item_id"], "left").select(
        "doc_id", "item_id", "n_windows", "n_found",
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
        F.round(F.col("n_found") / F.col("n_windows"), 6).alias("coverage"),
        F.round(F.coalesce("consistency", F.lit(1.0)), 6).alias("consistency"),
    )
    return joined.filter(F.col("consistency") >= consistent)


def slot_values(found: DataFrame, texts: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """(doc_id, item_id, n_slots, n_changed, consistency) of the pairs whose item has slots."""
    items = with_canonical(benchmark.dropDuplicates(["item_id"]).select("item_id", "text"), "text", "c")
    items = items.select("item_id", F.arrays_zip(words(F.col("text")).alias("v"), "c").alias("q"))
    typed = items.select("item_id", F.posexplode("q").alias("at", "s")).filter(F.col("s.c").isin(NUMBER, NAME, UNIT))
    slotted = found.join(typed, "item_id").filter(
        (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi") + window)
    ).select("doc_id", "item_id", "shift", "at", F.lower("s.v").alias("item_value"))
    wanted = slotted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift", "at", "item_value")).alias("asked"))
    ids = stored(wanted, "slots")
    few = F.broadcast(ids) if fits(ids.select("doc_id", F.to_json("asked"))) else ids.hint("shuffle_hash")
    values = texts.join(few, "doc_id").select(
        "doc_id", words(F.col("text")).alias("p"), F.explode("asked").alias("a")
    ).select(
        "doc_id", "a.item_id", "a.item_value", F.col("a.at").alias("at"),
        F.lower(F.get("p", F.col("a.at") + F.col("a.shift"))).alias("value"),
    ).distinct()
    per_value = values.groupBy("doc_id", "item_id", "item_value").agg(
        F.countDistinct("value").alias("kinds"), F.count(F.lit(1)).alias("n"),
        F.sum((F.col("value") != F.col("item_value")).cast("int")).alias("changed"),
    )
    return per_value.groupBy("doc_id", "item_id").agg(
        F.sum("n").alias("n_slots"), F.sum("changed").alias("n_changed"),
        F.avg((F.col("kinds") == 1).cast("double")).alias("consistency"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__bad")).distinct()
    side = F.broadcast(bad) if fits(bad) else bad
    return docs.join(side, F.col("doc_id").cast("long") == F.col("__bad"), "left_anti")
