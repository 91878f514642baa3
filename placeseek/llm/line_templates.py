"""Line dedup by a log-template tree, in DataFrame operations.

Every line runs down a tree of fixed depth: first by its number of tokens, then by its
leading tokens. Tokens that hold a digit are variable fields (``<*>``) from the start. In a
leaf with several different lines, each place keeps its most frequent token (by documents)
as the leaf's template; lines that agree with it in at least ``AGREE`` of all places belong
to the template, and their other places are variable fields too. Other lines are templates
of their own. A template found in ``MIN_DOCS`` documents or more recurs: its lines stay in
the first of these documents (smallest doc_id) and are dropped from all others.

Lines with fewer than ``MIN_TOKENS`` tokens, blank ones among them, carry too little to tell
and always stay. Runs of white space count as one blank; letter case counts. Null text stays
null, empty text stays empty; a document all of whose lines go keeps its row with empty
text. Rows without doc_id stay as they are. Rows with the same doc_id are one document and
must not differ. An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.session import stored

DEPTH = 3
AGREE = 0.7
MIN_DOCS = 2
MIN_TOKENS = 6
FIELD = "<*>"


def normalised(line: Column) -> Column:
    """Tokens parted by single blanks, those with a digit as a field."""
    plain = F.trim(F.regexp_replace(line, r"[ \t\r\f\x0B]+", " "))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"[^ ]*[0-9][^ ]*", FIELD)).otherwise(plain)


def lines_of(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """(doc_id, pos, n, leaf, pattern): a row per line, without its text."""
    lines = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode_outer(F.split("text", "\n")).alias("pos", "line")
    )
    cut = lines.select("doc_id", "pos", normalised(F.col("line")).alias("norm"))
    cut = cut.select("doc_id", "pos", "norm", F.split("norm", " ").alias("t"))
    n = F.size("t")
    return cut.filter(n >= min_tokens).select(
        "doc_id", "pos", n.alias("n"),
        F.xxhash64(n, F.slice("t", 1, depth)).alias("leaf"), F.xxhash64("norm").alias("pattern"),
    )


def generalised(docs: DataFrame, rows: DataFrame, agree: float) -> DataFrame:
    """(leaf, pattern, template) of the lines that their leaf's template covers."""
    counted = rows.select("leaf", "pattern", "doc_id", "n").distinct().groupBy("leaf", "pattern", "n").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("doc_id")
    )
    busy = counted.groupBy("leaf").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("leaf")
    patterns = stored(counted.join(busy, "leaf", "left_semi"), "patterns")
    # The text of each pattern: one of its lines in its first document.
    keys = ["leaf", "pattern", "doc_id"]
    places = rows.join(patterns.select(*keys), keys).groupBy(*keys).agg(F.min("pos").alias("pos"))
    grouped = places.groupBy("doc_id").agg(F.collect_list(F.struct("leaf", "pattern", "pos")).alias("wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    found = texts.join(grouped.hint("shuffle_hash"), "doc_id").select(
        F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w")
    )
    words = found.select(
        "w.leaf", "w.pattern", F.split(normalised(F.get("lines", F.col("w.pos"))), " ").alias("t")
    ).dropDuplicates(["leaf", "pattern"])
    words = stored(words.join(patterns.select("leaf", "pattern", "docs"), ["leaf", "pattern"]), "pattern_words")
    support = (
        words.select("leaf", "docs", F.posexplode_outer("t").alias("at", "token"))
        .groupBy("leaf", "at", "token").agg(F.sum("docs").alias("docs"))
        .groupBy("leaf", "at").agg(F.max(F.struct("docs", "token")).alias("best"))
        .groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "best.token"))), lambda x: x["token"]).alias("common"))
    )
    same = F.aggregate(
        F.zip_with("t", "common", lambda a, b: a.eqNullSafe(b).cast("int")), F.lit(0), lambda total, x: total + x
    )
    return words.join(support, "leaf").filter(same >= agree * F.size("t")).select(
        "leaf", "pattern", F.xxhash64("leaf", F.lit("template")).alias("template")
    )


def dropped_lines(
    docs: DataFrame,
    depth: int = DEPTH,
    agree: float = AGREE,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """(doc_id, drop): the places, from 0, of the lines that go; documents that lose none are left out."""
    rows = stored(lines_of(docs, min_tokens, depth), "lines")
    wider = generalised(docs, rows, agree)
    templated = rows.join(wider, ["leaf", "pattern"], "left").select(
        "doc_id", "pos", F.coalesce("template", "pattern").alias("template")
    )
    templated = stored(templated, "templates")
    recurring = (
        templated.select("template", "doc_id").distinct()
        .groupBy("template").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first"))
        .filter(F.col("docs") >= min_docs)
    )
    gone = templated.join(recurring, "template").filter("doc_id <> first")
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def deduplicated(docs: DataFrame, **params) -> DataFrame:
    """``docs`` without the recurring lines, plus ``n_lines`` and ``n_dropped``, in place of columns of those names."""
    drops = dropped_lines(docs, **params).select(F.col("doc_id").alias("__doc_id"), F.col("drop").alias("__drop"))
    joined = docs.join(drops.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col("__doc_id"), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, at: ~F.array_contains("__drop", at))
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    others = [F.col(c) if c != "text" else text.alias("text") for c in own]
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines)
    return joined.select(
        *others, n_lines.alias("n_lines"), F.coalesce(F.size("__drop"), F.lit(0)).alias("n_dropped")
    )
