"""Inverted index as ordinary tables that grow by segments, and BM25 ranking that skips.

Documents lie in ranges of at most ``RANGE_DOCS``. The postings of one term in one range are a
block: per term frequency the places of its documents in the range, and the least length
among them. That bounds the weight of the term in the range for any mean length, so a search first
works out, from block heads alone, the best score a range can reach per query. The
most promising ranges are scored, their k-th best hit becomes the query's threshold, and blocks are
read only in ranges that can still beat it. Inside a task a range is scored on arrays; what leaves it
is k rows per query, never a row per query and document.

An index is a folder of immutable segments. Appending documents writes one more segment;
statistics of the whole are sums over segments. ``compact`` merges segments of like size
without looking at texts, and readers keep the version they opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek import sizing
from placeseek.functions import kernels
from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.operators.positions import with_running_total
from placeseek.operators.topk import top_k
from placeseek.session import parallelism, stored
from placeseek.sizing import fits, join_checked, localised, one_of

K1 = 1.5
B = 0.75
# Share of the mean weight given to terms whose own weight is negative.
FLOOR_SHARE = 0.25
# Scores are compared after rounding, because equal texts must tie.
SCORE_DIGITS = 6
# A bound may fall short of a rounded score by its rounding.
SLACK = 2.0 * 10**-SCORE_DIGITS
# Up to this many query terms are pushed down to the scans as a filter.
PUSHED_TERMS = 200
# A merged range may hold twice as many; a bitmap of a range has 32,768 bits.
RANGE_DOCS = 4_096
# A range of long documents ends before it has more words; their numbers are sorted in one task.
RANGE_WORDS = 8_000_000
# Queries that are scored together in one task.
QUERY_PART = 1_024
# Segments of like size that are merged together.
FAN = 8
# Ranges per query that are scored for its threshold; k of them if that is more.
FIRST_LOOK = 32

FLOORED = "floored"
SMOOTHED = "smoothed"

WHERE = ["segment", "range"]
CLASS = "struct<tf:int,dl:int,places:array<int>>"
BLOCKS = f"term string, range long, classes array<{CLASS}>, segment int, bucket int"
RANGES = "range long, n int, doc_ids array<long>, dls array<int>, segment int"
TERMS = "bucket int, term string, df long, segment int"
VERSIONS = "segment int, n long, total_len long, mean_idf double, buckets int, version int"


@dataclass(frozen=True)
class LexicalIndex:
    """Tables of one version of an index.

    blocks  (segment, bucket, term, range, classes): partitioned by segment and a hash of the
            term, sorted by term; ``classes`` are (tf, dl, places), ``dl`` the least length.
            Bucket -1 of the files holds what a range's documents were when it was written
    ranges  (segment, range, n, doc_ids, dls): the documents of a range by place
    terms   (bucket, term, df) over all segments
    corpus  one row (n, total_len, mean_idf)
    """

    path: str
    version: int
    segments: dict[int, tuple[int, int]]
    blocks: DataFrame
    ranges: DataFrame
    terms: DataFrame
    corpus: DataFrame
    buckets: int
    n: int
    avgdl: float
    mean_idf: float

    @property
    def documents(self) -> DataFrame:
        """(doc_id, dl)"""
        return self.ranges.select(F.inline(F.arrays_zip("doc_ids", "dls"))).select(
            F.col("doc_ids").alias("doc_id"), F.col("dls").cast("long").alias("dl")
        )

    @property
    def postings(self) -> DataFrame:
        """(term, doc_id, tf, dl), a row per posting.

        Blocks meet their range before they are unfolded, so that postings are not shuffled.
        """
        ranges = self.ranges.select(*WHERE, "doc_ids", "dls")
        ranges = F.broadcast(ranges) if fits(ranges) else ranges.hint("shuffle_hash")
        met = self.blocks.select("term", *WHERE, "classes").join(ranges, WHERE)
        classes = met.select("term", "doc_ids", "dls", F.inline("classes").alias("tf", "dl", "places"))
        places = classes.select("term", "doc_ids", "dls", "tf", F.explode("places").alias("place"))
        return places.select(
            "term", F.get("doc_ids", "place").alias("doc_id"), F.col("tf").cast("long").alias("tf"),
            F.get("dls", "place").cast("long").alias("dl"),
        )


def bucket_of(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


# -- building ---------------------------------------------------------------------------


def _classes(rows: DataFrame, places: Column) -> DataFrame:
    """Blocks from rows (bucket, term, range, tf, dl); ``places`` brings those of one frequency together."""
    by_tf = rows.groupBy("bucket", "range", "term", "tf").agg(F.min("dl").alias("dl"), places.alias("places"))
    whole = F.collect_list(F.struct("tf", "dl", "places"))
    return by_tf.groupBy("bucket", "range", "term").agg(whole.alias("classes"))


def _write_terms(spark: SparkSession, path: str, segment: int) -> None:
    at = f"segment={segment}"
    heads = spark.read.schema("term string, classes array<struct<places:array<int>>>, bucket int").parquet(f"{path}/blocks/{at}")
    held = F.aggregate("classes.places", F.lit(0).cast("long"), lambda n, p: n + F.size(p))
    terms = heads.filter("bucket >= 0").select("bucket", "term", held.alias("n")).groupBy("bucket", "term").agg(F.sum("n").alias("df"))
    terms.write.parquet(f"{path}/terms/{at}")


def _write_blocks(blocks: DataFrame, path: str, segment: int) -> None:
    ordered = blocks.sortWithinPartitions("bucket", "term", "range")
    ordered.write.partitionBy("bucket").parquet(f"{path}/blocks/segment={segment}")


def _build_segment(docs: DataFrame, path: str, segment: int, text: str, range_docs: int, buckets: int) -> None:
    """Write the tables of ``docs``. Every text is read and tokenised once.

    A range is a stretch of one task's documents, so that task makes its blocks and nothing is shuffled.
    """
    spark = docs.sparkSession
    words = docs.select(
        F.monotonically_increasing_id().alias("_at"), F.col("doc_id").cast("long").alias("doc_id"), tx.tokens(F.col(text)).alias("words")
    )
    built = words.mapInArrow(
        kernels.blocks_of_ranges(range_docs, RANGE_WORDS),
        f"term string, range long, classes array<{CLASS}>, doc_ids array<long>, dls array<int>",
    )
    # Rows of ranges have no term. Written together, as another run might deal documents otherwise.
    bucket = F.when(F.col("term").isNull(), F.lit(-1)).otherwise(bucket_of("term", buckets))
    _write_blocks(built.withColumn("bucket", bucket), path, segment)
    ranges = spark.read.schema("range long, doc_ids array<long>, dls array<int>, bucket int").parquet(f"{path}/blocks/segment={segment}")
    ranges = ranges.filter("bucket = -1").select("range", F.size("doc_ids").alias("n"), "doc_ids", "dls")
    ranges.write.parquet(f"{path}/ranges/segment={segment}")
    _write_terms(spark, path, segment)


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    if not sizing.exists(spark, f"{path}/versions"):
        return None
    return spark.read.schema(VERSIONS).parquet(f"{path}/versions")


def _commit(spark: SparkSession, path: str, segments: dict[int, tuple[int, int]], version: int, buckets: int) -> None:
    """Make ``segments`` (number to documents and words) the newest version.

    The mean weight of the vocabulary comes from the counts of equal document frequencies.
    """
    n = sum(s[0] for s in segments.values())
    terms = _terms(spark, path, list(segments))
    mean = 0.0
    if n:
        sums = terms.groupBy("df").agg(F.count(F.lit(1)).alias("c"))
        mean = sums.agg(F.sum(F.col("c") * vx.plain_idf(F.lit(n), F.col("df"))) / F.sum("c")).first()[0] or 0.0
    rows = [(s, *segments[s], mean, buckets, version) for s in sorted(segments)]
    table = spark.createDataFrame(rows, VERSIONS).coalesce(1)
    table.write.mode("append").partitionBy("version").parquet(f"{path}/versions")


def _terms(spark: SparkSession, path: str, segments: list[int]) -> DataFrame:
    reader = spark.read.schema(TERMS).option("basePath", f"{path}/terms")
    found = reader.parquet(*[f"{path}/terms/segment={s}" for s in segments])
    if len(segments) == 1:
        return found.select("bucket", "term", "df")
    return found.groupBy("bucket", "term").agg(F.sum("df").alias("df"))


def append_index(
    docs: DataFrame, path: str, text: str = "text", range_docs: int = RANGE_DOCS
) -> LexicalIndex:
    """Add ``docs(doc_id, text)`` with ids not yet in the index as one more segment.

    What is stored is neither read again nor rewritten. One writer at a time.
    """
    spark = docs.sparkSession
    versions = _versions(spark, path)
    before = load_index(spark, path) if versions is not None else None
    buckets = before.buckets if before else min(64, parallelism(spark))
    segment = versions.agg(F.max("segment")).first()[0] + 1 if before else 0
    _build_segment(docs, path, segment, text, range_docs, buckets)
    added = spark.read.schema(RANGES).parquet(f"{path}/ranges/segment={segment}").agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("dls", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)),
    ).first()
    segments = dict(before.segments) if before else {}
    segments[segment] = (added[0], added[1])
    _commit(spark, path, segments, before.version + 1 if before else 0, buckets)
    return load_index(spark, path)


def build_index(docs: DataFrame, path: str, text: str = "text", range_docs: int = RANGE_DOCS) -> LexicalIndex:
    """Write the index of ``docs(doc_id, text)`` under the new folder ``path``."""
    return append_index(docs, path, text, range_docs)


def load_index(spark: SparkSession, path: str, version: int | None = None) -> LexicalIndex:
    """The newest version of an index, or an earlier one whose files are still there."""
    versions = _versions(spark, path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    rows = versions.filter(F.col("version") == version).collect()  # a row per segment
    segments = {r.segment: (r.n, r.total_len) for r in rows}
    n, total = (sum(s[k] for s in segments.values()) for k in (0, 1))

    def table(name: str, schema: str) -> DataFrame:
        places = [f"{path}/{name}/segment={s}" for s in segments]
        return spark.read.schema(schema).option("basePath", f"{path}/{name}").parquet(*places)

    corpus = spark.createDataFrame([(n, total, rows[0].mean_idf)], "n long, total_len long, mean_idf double")
    return LexicalIndex(
        path, version, segments, table("blocks", BLOCKS).filter("bucket >= 0"), table("ranges", RANGES), _terms(spark, path, list(segments)),
        corpus, rows[0].buckets, n, total / n if n else 0.0, rows[0].mean_idf,
    )


# -- merging segments ---------------------------------------------------------------------


def merge_segments(spark: SparkSession, path: str, chosen: list[int], range_docs: int = RANGE_DOCS) -> LexicalIndex:
    """Replace the ``chosen`` segments of the newest version by one.

    Small ranges are joined up to ``range_docs`` documents; places move by the number of documents
    before them. Blocks of a range that stays alone keep their places and are not shuffled. Only
    tables of the index are read.
    """
    index = load_index(spark, path)
    segment = _versions(spark, path).agg(F.max("segment")).first()[0] + 1
    mine = F.col("segment").isin(chosen)
    ranges, blocks = index.ranges.filter(mine), index.blocks.filter(mine)
    placed = with_running_total(ranges.select(*WHERE, "n"), WHERE, F.col("n"), "_upto")
    # No range outgrows twice the bound: those of a group end within one stretch of it.
    grouped = placed.select(*WHERE, (F.col("_upto") - F.col("n")).alias("_before"), F.floor((F.col("_upto") - 1) / range_docs).alias("_to"))
    first = grouped.groupBy("_to").agg(F.min("_before").alias("_first"), (F.count(F.lit(1)) == 1).alias("_alone"))
    moved = stored(
        grouped.join(first, "_to").select(
            *WHERE, F.col("_to").cast("long").alias("_to"), (F.col("_before") - F.col("_first")).cast("int").alias("_shift"), "_alone"
        ),
        "moved",
    )
    small = fits(moved)

    def at_new_place(rows: DataFrame) -> DataFrame:
        return join_checked(rows, moved, WHERE, small_fits=small).drop(*WHERE).withColumnRenamed("_to", "range")

    parts = F.sort_array(F.collect_list(F.struct("_shift", "doc_ids", "dls")))
    new_ranges = at_new_place(ranges).groupBy("range").agg(F.sum("n").cast("int").alias("n"), parts.alias("_p")).select(
        "range", "n", F.flatten("_p.doc_ids").alias("doc_ids"), F.flatten("_p.dls").alias("dls")
    )
    placed_blocks = at_new_place(blocks)
    alone = placed_blocks.filter("_alone").select("bucket", "range", "term", "classes")
    classes = placed_blocks.filter(~F.col("_alone")).select(
        "bucket", "range", "term", "_shift", F.inline("classes").alias("tf", "dl", "places")
    ).select(
        "bucket", "range", "term", "tf", "dl",
        F.transform("places", lambda p: p + F.col("_shift")).alias("places"),
    ).repartition(parallelism(spark), "bucket", "range")
    new_ranges.write.parquet(f"{path}/ranges/segment={segment}")
    _write_blocks(_classes(classes, F.flatten(F.collect_list("places"))).unionByName(alone), path, segment)
    _terms(spark, path, chosen).write.parquet(f"{path}/terms/segment={segment}")
    segments = {s: v for s, v in index.segments.items() if s not in chosen}
    segments[segment] = tuple(sum(index.segments[s][k] for s in chosen) for k in (0, 1))
    _commit(spark, path, segments, index.version + 1, index.buckets)
    return load_index(spark, path)


def compact(spark: SparkSession, path: str, fan: int = FAN, range_docs: int = RANGE_DOCS) -> LexicalIndex:
    """Merge segments until fewer than ``fan`` are of one size class, each ``fan`` times the last.

    A document is thus rewritten a number of times that grows with the logarithm of the corpus. A job
    of its own may do this beside searches, which go on with the version they opened.
    """
    index = load_index(spark, path)
    while True:
        classes: dict[int, list[int]] = {}
        for segment, (n, _) in index.segments.items():
            size = 0
            while fan ** (size + 1) <= n:
                size += 1
            classes.setdefault(size, []).append(segment)
        full = [c for _, c in sorted(classes.items()) if len(c) >= fan]
        if not full:
            return index
        index = merge_segments(spark, path, full[0], range_docs)


# -- searching ------------------------------------------------------------------------------


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, qtf); a blank query yields no row and so finds nothing."""
    return (
        queries.select("query_id", F.explode_outer(tx.tokens(F.col("query"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def weighted_terms(terms: DataFrame, index: LexicalIndex, form: str) -> DataFrame:
    """Add the inverse document frequency ``idf`` in one of the two forms."""
    n = F.lit(index.n)
    if form == SMOOTHED:
        return terms.withColumn("idf", vx.smoothed_idf(n, F.col("df")))
    if form != FLOORED:
        raise ValueError(f"unknown weight form {form!r}")
    plain = vx.plain_idf(n, F.col("df"))
    floor = F.lit(FLOOR_SHARE * index.mean_idf)
    return terms.withColumn("idf", F.when(plain < 0, floor).otherwise(plain))


def _matching(table: DataFrame, rows: list | None) -> DataFrame:
    """Restrict a term table to the asked terms by filters the scan can use."""
    if rows is None:
        return table
    wanted = sorted({r["term"] for r in rows})
    if len(wanted) > PUSHED_TERMS:
        return table
    buckets = sorted({r["bucket"] for r in rows})
    return table.filter(one_of("bucket", buckets)).filter(one_of("term", wanted))


def allowed_places(index: LexicalIndex, allowed: DataFrame) -> DataFrame:
    """(segment, range, n, least_id, bits): the ``allowed(doc_id)`` documents as a bitmap per range.

    Ranges without one drop out, and with them their blocks.
    """
    places = index.ranges.select(*WHERE, F.posexplode("doc_ids").alias("place", "doc_id"))
    kept = join_checked(places, stored(allowed.select("doc_id").distinct(), "ids"), "doc_id", "left_semi")
    return kept.groupBy(*WHERE).agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.min("doc_id").alias("least_id"),
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"),
    )


def _heads(index: LexicalIndex, allowed: DataFrame | None) -> DataFrame:
    """(segment, range, n, least_id, bits) of the ranges that take part."""
    if allowed is not None:
        return stored(allowed_places(index, allowed), "allowed")
    return index.ranges.select(*WHERE, "n", F.array_min("doc_ids").alias("least_id"), F.lit(None).cast("binary").alias("bits"))


def _bounds(
    index: LexicalIndex, heads: DataFrame, asked: DataFrame, weights: DataFrame, rows: list | None, small: bool,
    k: int, negative: bool, k1: float, b: float,
) -> DataFrame:
    """(query_id, segment, range, bound, least_id): what a range can give a query at most.

    Documents without a query word score 0. Unless weights are negative, no document
    scores less, so of ranges without a query word only the k with the lowest ids can matter.
    """
    peak = F.array_max(
        F.zip_with(
            "classes.tf", "classes.dl",
            lambda tf, dl: vx.term_weight(tf, dl, F.lit(index.avgdl), k1, b),
        )
    )
    blocks = _matching(index.blocks, rows)
    if small:
        blocks = blocks.join(F.broadcast(weights.select("term").distinct()), "term", "left_semi")
    peaks = blocks.select("term", *WHERE, peak.alias("peak"))
    part = F.greatest(F.col("qtf") * F.col("idf") * F.col("peak"), F.lit(0.0))
    matched = join_checked(peaks, weights, "term", spread="range", small_fits=small).select("query_id", *WHERE, part.alias("bound"))
    others = heads.select(*WHERE, "least_id")
    if not negative:
        others, _ = localised(others.orderBy("least_id", *WHERE).limit(k), k)
    ids = asked.select("query_id").distinct()
    # A query set against ranges, each once: the broadcast side is checked or has k rows.
    if negative and not fits(ids):
        others = F.broadcast(others) if fits(others) else others
        unmatched = ids.join(others)
    else:
        unmatched = others.join(F.broadcast(ids)) if negative or fits(ids) else ids.join(F.broadcast(others))
    unmatched = unmatched.select("query_id", *WHERE, F.lit(0.0).alias("bound"))
    summed = matched.unionByName(unmatched).groupBy("query_id", *WHERE).agg(F.sum("bound").alias("bound"))
    return join_checked(summed, heads.select(*WHERE, "least_id"), WHERE, small_fits=fits(heads.select(*WHERE)))


def _scored(
    index: LexicalIndex, heads: DataFrame, wanted: DataFrame, weights: DataFrame, rows: list | None, small: bool,
    k: int, parts: int, k1: float, b: float, whole: bool = False,
) -> DataFrame:
    """(query_id, doc_id, score): the k best documents of each wanted (query_id, segment, range).

    Blocks of a wanted range meet in one task, once for ``QUERY_PART`` queries; a range is bounded.
    ``whole`` says that all of the few ranges in ``heads`` are wanted.
    """
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    wanted = wanted.withColumn("part", part)
    if whole:
        live = heads.select(*WHERE, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    else:
        live = wanted.select(*WHERE, "part").distinct()
    live_fits = whole or fits(live)
    places = join_checked(index.ranges.select(*WHERE, "doc_ids", "dls"), heads.select(*WHERE, "bits"), WHERE, small_fits=whole)
    blocks = _matching(index.blocks, rows).select(
        "term", *WHERE, F.col("classes.tf").alias("tfs"), F.transform("classes.places", F.size).alias("sizes"),
        F.flatten("classes.places").alias("places"),
    )
    if small:
        blocks = blocks.join(F.broadcast(weights.select("term").distinct()), "term", "left_semi")

    def shared(table: DataFrame) -> DataFrame:
        return join_checked(table, live, WHERE, small_fits=live_fits)

    none = F.lit(None)
    lists = none.cast("array<int>")
    left = shared(blocks).select(
        *WHERE, "part", "term", "tfs", "sizes", "places", none.cast("array<long>").alias("doc_ids"), lists.alias("dls"),
        none.cast("binary").alias("bits"),
    ).unionByName(
        shared(places).select(
            *WHERE, "part", none.cast("string").alias("term"), *[lists.alias(c) for c in ("tfs", "sizes", "places")],
            "doc_ids", "dls", "bits",
        )
    )
    terms = weights.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("term", (F.col("qtf") * F.col("idf")).alias("weight")))).alias("terms")
    )  # a row per query, with its own words
    right = wanted.join(F.broadcast(terms) if small else terms, "query_id", "left").select(
        # Renamed, as both sides of the meeting come from ``wanted``.
        *[F.col(c).alias(c) for c in (*WHERE, "part")], "query_id", "floor",
        F.col("terms.term").alias("terms"), F.col("terms.weight").alias("weights"),
    )
    keys = [*WHERE, "part"]
    run = kernels.best_of_range(k, index.avgdl, k1, b, SCORE_DIGITS)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, doc_id long, score double")


def search(
    index: LexicalIndex,
    queries: DataFrame,
    k: int = 12,
    form: str = FLOORED,
    allowed: DataFrame | None = None,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents per query, exactly.

    Repeats of a query word count; words the corpus lacks add nothing; documents without a query
    word score 0 and fill the list. Ties go to the lower id. With ``allowed(doc_id)`` only those
    documents are ranked, so k of them are found whenever there are k.
    """
    asked, rows = localised(query_terms(queries).withColumn("bucket", bucket_of("term", index.buckets)))
    small = rows is not None or fits(asked)
    n_queries = len({r["query_id"] for r in rows}) if rows is not None else asked.select("query_id").distinct().count()
    parts = max(1, -(-n_queries // QUERY_PART))
    vocabulary = _matching(index.terms, rows).select("term", "df")
    weights = join_checked(
        weighted_terms(vocabulary, index, form), asked.drop("bucket"), "term", small_fits=small
    ).select("term", "query_id", "qtf", "idf")
    if rows is not None:
        weights, _ = localised(weights)
    else:
        weights = stored(weights, "weights")
    heads = _heads(index, allowed)
    # Each range has a document, so k ranges hold at least k.
    look = max(k, FIRST_LOOK)
    if heads.limit(look + 1).count() <= look:
        # The first look is at all of them.
        heads, _ = localised(heads, look)
        ids = asked.select("query_id").distinct()
        wanted = ids.join(F.broadcast(heads.select(*WHERE))).withColumn("floor", F.lit(None).cast("double"))
        scores = _scored(index, heads, wanted, weights, rows, small, k, parts, k1, b, whole=True)
        return rank(scores, k).select("query_id", "rank", "doc_id", "score")
    negative = form == FLOORED and index.mean_idf < 0
    bounds = stored(_bounds(index, heads, asked, weights, rows, small, k, negative, k1, b), "bounds")
    best = [F.desc("bound"), F.asc("least_id"), F.asc("segment"), F.asc("range")]
    chosen = stored(
        top_k(bounds.withColumn("_at", F.struct(*WHERE)), ["query_id"], best, look, "_at", rank="_look").select("query_id", *WHERE),
        "first",
    )
    seen = stored(
        _scored(index, heads, chosen.withColumn("floor", F.lit(None).cast("double")), weights, rows, small, k, parts, k1, b),
        "seen",
    )
    last = rank(seen, k).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("score").alias("floor"), F.max_by("doc_id", "rank").alias("last_id")
    )
    fewer = F.col("_n") < k
    left = bounds.join(chosen, ["query_id", *WHERE], "left_anti")
    left = left.join(F.broadcast(last) if small else last, "query_id", "left").filter(
        fewer | F.col("floor").isNull()
        | (F.col("bound") + SLACK >= F.col("floor")) & (F.col("bound") > 0)
        | (F.col("bound") == 0) & ((F.col("floor") < 0) | (F.col("floor") == 0) & (F.col("least_id") < F.col("last_id")))
    ).withColumn("floor", F.when(~fewer, F.col("floor"))).select("query_id", *WHERE, "floor")
    more = _scored(index, heads, stored(left, "left"), weights, rows, small, k, parts, k1, b)
    return rank(seen.unionByName(more), k).select("query_id", "rank", "doc_id", "score")


def rank(scores: DataFrame, k: int) -> DataFrame:
    """The k best documents per query, best first; ties go to the lower id."""
    return top_k(scores, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, "doc_id")


def first_by_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, first_id, copies): for each distinct text the lowest id that carries it.

    Texts are compared by a 256-bit digest, so the shuffle moves fixed-size keys, and
    copies of one text are reduced to one row before it.
    """
    return docs.groupBy(F.sha2(F.col(text), 256).alias("digest")).agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )


def resolve_by_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, first_id): where a lookup by text equality lands for each document."""
    digests = docs.select("doc_id", F.sha2(F.col(text), 256).alias("digest"))
    firsts = first_by_text(docs, text)
    hot = firsts.filter(F.col("copies") > sizing.HOT_ROWS).select("digest")
    return join_checked(
        digests, firsts, "digest", spread="doc_id", small_fits=False, hot=hot
    ).select("doc_id", "first_id")
