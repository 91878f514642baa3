"""Signals beside the text score: queries G1 to G9."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.operators import lexical, rerank, semantic, variety
from placeseek.operators.hits import attach_posts
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.session import work_path
from placeseek.sources.tables import posts_from_documents, table
from placeseek.streaming.trend import activity_change_stream

TOP = 12
FUSED = 10
CUES = {"positive": ("of the", "and the", "de la", "und"), "negative": ("on the", "la", "hidden gem")}
TAGS = {"geography": ("the", "der"), "culture": ("les", "rethe"), "experience": ("und", "hea", "in")}


def sql_phrases(phrase: str) -> str:
    needle = " " + "  ".join(phrase.split()) + " "
    return f"((length(w) - length(replace(w, '{needle}', ''))) // {len(needle)})"


WORDS = f"words AS (SELECT doc_id AS id, ' ' || array_to_string({shared.sql_tokens('text')}, '  ') || ' ' AS w FROM documents)"
FOUND_CUES = (
    "cues AS ("
    + " UNION ALL ".join(
        f"SELECT id, '{p}' AS polarity, '{c}' AS cue, CAST({sql_phrases(c)} AS INTEGER) AS n FROM words"
        for p, phrases in CUES.items()
        for c in phrases
    )
    + ")"
)


def _cues(spark, folder):
    return rerank.cue_counts(posts_from_documents(spark, folder, ("id", "content"), busy=True), CUES)


@query("g1_context_cues", f"WITH {WORDS}, {FOUND_CUES} SELECT * FROM cues WHERE n > 0")
def context_cues(spark, folder):
    return _cues(spark, folder)


@query(
    "g1_context_cue_maps",
    f"""WITH {WORDS}, {FOUND_CUES}
SELECT id, string_agg(cue || '=' || n, ',' ORDER BY cue) FILTER (WHERE polarity = 'positive') AS positive,
       string_agg(cue || '=' || n, ',' ORDER BY cue) FILTER (WHERE polarity = 'negative') AS negative
FROM cues WHERE n > 0 GROUP BY id""",
)
def context_cue_maps(spark, folder):
    """The nested maps, printed as ``cue=count`` lists."""
    maps = rerank.cue_map(_cues(spark, folder))

    def printed(polarity):
        entries = F.array_sort(F.map_entries(F.try_element_at("context_cues", F.lit(polarity))))
        text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
        return text.alias(polarity)

    return maps.select("id", printed("positive"), printed("negative"))


@query(
    "g2_attribute_match",
    f"""SELECT doc_id AS id, round(({' + '.join(f"CAST(list_has_any(w, {list(t)}) AS INTEGER)" for t in TAGS.values())}) / 3.0, 6) AS attribute_share
FROM (SELECT doc_id, {shared.sql_tokens('text')} AS w FROM documents)""",
)
def attribute_match(spark, folder):
    shares = rerank.attribute_match(posts_from_documents(spark, folder, ("id", "content"), busy=True), TAGS)
    return shares.select("id", F.round("attribute_share", 6).alias("attribute_share"))


def _lexical(spark, folder, k):
    found = lexical.search(
        shared.corpus_index(spark, folder), shared.benchmark_queries(spark, folder), k
    )
    return found.withColumnRenamed("doc_id", "id")


@query(
    "g3_query_overlap",
    f"""WITH {shared.sql_hits(TOP)}
SELECT query_id, h.id, round(len(list_intersect(list_distinct({shared.sql_tokens('query')}), {shared.sql_tokens('content')}))
  / len(list_distinct({shared.sql_tokens('query')})), 6) AS overlap
FROM hits h JOIN posts p ON p.id = h.id JOIN queries USING (query_id)""",
)
def query_overlap(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url", "content"))
    found = attach_posts(_lexical(spark, folder, TOP), posts, key="id")
    asked = shared.benchmark_queries(spark, folder)
    overlap = rerank.query_overlap(found, asked)
    return overlap.select("query_id", "id", F.round("overlap", 6).alias("overlap"))


DAMPED = """
popularity AS (SELECT location_name, count(*) AS at_place FROM posts GROUP BY location_name),
damped AS (
  SELECT query_id, rank, h.id, location_name, score, score / (1 + ln(at_place)) AS damped
  FROM hits h JOIN posts p ON p.id = h.id JOIN popularity USING (location_name))"""


def _damped(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url", "location_name"))
    found = attach_posts(_lexical(spark, folder, TOP), posts, key="id")
    return rerank.damped(found, posts)


@query(
    "g4_popularity_dampening",
    f"WITH {shared.sql_hits(TOP)}, {DAMPED} SELECT query_id, id, location_name, round(damped, 6) AS damped FROM damped",
)
def popularity_dampening(spark, folder):
    return _damped(spark, folder).select(
        "query_id", "id", "location_name", F.round("damped", 6).alias("damped")
    )


def _both_sql():
    vectors = shared.sql_near(FUSED)
    return f"{shared.sql_hits(FUSED)}, {vectors[vectors.index('keys AS (') :]}"


FUSION = f"""
merged AS (
  SELECT query_id, id, h.rank AS lexical_rank, n.rank AS semantic_rank,
         round(coalesce(1.0 / (60 + h.rank), 0) + coalesce(1.0 / (60 + n.rank), 0), 8) AS fused
  FROM hits h FULL OUTER JOIN near n USING (query_id, id)),
fusion AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, id) AS rank FROM merged) WHERE rank <= {FUSED})"""


def _fused(spark, folder):
    near = semantic.nearest(
        shared.corpus_pivots(spark, folder),
        shared.encode_queries(shared.benchmark_queries(spark, folder)),
        FUSED,
    )
    return rerank.fused(_lexical(spark, folder, FUSED), near, FUSED)


@query(
    "g5_rank_fusion",
    f"WITH {_both_sql()}, {FUSION} SELECT query_id, rank, id, fused, lexical_rank, semantic_rank FROM fusion",
)
def rank_fusion(spark, folder):
    return _fused(spark, folder).select(
        "query_id", "rank", "id", "fused", "lexical_rank", "semantic_rank"
    )


WEIGHTS = {"fused": 10.0, "cue_balance": 0.01, "attribute_share": 0.5, "overlap": 1.0}
WEIGHTED = " + ".join(f"{w} * {name}" for name, w in WEIGHTS.items())


@query(
    "g5_weighted_rerank",
    f"""WITH {_both_sql()}, {FUSION}, {WORDS}, {FOUND_CUES},
balance AS (SELECT id, CAST(sum(CASE WHEN polarity = 'positive' THEN n ELSE -n END) AS BIGINT) AS cue_balance FROM cues GROUP BY id),
popularity AS (SELECT location_name, count(*) AS at_place FROM posts GROUP BY location_name),
signals AS (
  SELECT query_id, f.id, fused, cue_balance, at_place,
         ({' + '.join(f"CAST(list_has_any({shared.sql_tokens('content')}, {list(t)}) AS INTEGER)" for t in TAGS.values())}) / {float(len(TAGS))} AS attribute_share,
         len(list_intersect(list_distinct({shared.sql_tokens('query')}), {shared.sql_tokens('content')}))
           / len(list_distinct({shared.sql_tokens('query')})) AS overlap
  FROM fusion f JOIN posts p ON p.id = f.id JOIN queries USING (query_id) JOIN balance b ON b.id = f.id
  JOIN popularity USING (location_name)),
finals AS (SELECT query_id, id, round(({WEIGHTED}) / (1 + ln(at_place)), 6) AS final FROM signals)
SELECT query_id, id, final, row_number() OVER (PARTITION BY query_id ORDER BY final DESC, id) AS final_rank FROM finals""",
)
def weighted_rerank(spark, folder):
    """Fused score with the four signals: cues, tags, query words, and damping of popular places."""
    columns = ("id", "page_url", "content", "location_name")
    posts = posts_from_documents(spark, folder, columns)
    fused = attach_posts(_fused(spark, folder), posts, key="id")
    known = rerank.with_signals(fused, posts, shared.benchmark_queries(spark, folder), CUES, TAGS)
    out = rerank.reordered(known, WEIGHTS, damping=F.col("damping"), digits=6)
    return out.select("query_id", "id", "final", "final_rank")


def _sql_country():
    return "CASE WHEN strpos(location_name, ',') = 0 THEN '' ELSE trim(string_split(location_name, ',')[-1]) END"


@query(
    "g6_metadata_filter",
    f"""WITH {shared.POSTS} SELECT id, location_name FROM posts
WHERE {_sql_country()} IN ('ASIA', 'EUROPE')
  AND ((latitude BETWEEN -34 AND 37 AND longitude BETWEEN -18 AND 51) OR
       (latitude BETWEEN 7 AND 83 AND longitude BETWEEN -168 AND -52))
  AND list_has_any({shared.sql_tokens('content')}, ['the', 'und'])""",
)
def metadata_filter(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "location_name", "latitude", "longitude", "content"))
    kept = rerank.restricted(
        posts, countries=("ASIA", "EUROPE"), continents=("Africa", "North America"), tags=("the", "und")
    )
    return kept.select("id", "location_name")


ALLOWED = f"""allowed AS (
  SELECT id FROM posts
  WHERE {_sql_country()} IN ('ASIA', 'EUROPE')
    AND ((latitude BETWEEN -34 AND 37 AND longitude BETWEEN -18 AND 51) OR
         (latitude BETWEEN 7 AND 83 AND longitude BETWEEN -168 AND -52))
    AND list_has_any({shared.sql_tokens('content')}, ['the', 'und']))"""


@query(
    "g6_filtered_search_lexical",
    f"""WITH {shared.sql_hits(TOP)}, {ALLOWED}
SELECT query_id, rank, id, score FROM (
  SELECT query_id, doc_id AS id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM complete WHERE doc_id IN (SELECT id FROM allowed)) WHERE rank <= {TOP}""",
)
def filtered_search_lexical(spark, folder):
    """The best posts among those that pass the filter, by text."""
    allowed = metadata_filter(spark, folder).select(F.col("id").alias("doc_id"))
    found = lexical.search(
        shared.corpus_index(spark, folder), shared.benchmark_queries(spark, folder), TOP, allowed=allowed
    )
    return found.select("query_id", "rank", F.col("doc_id").alias("id"), "score")


@query(
    "g6_filtered_search_semantic",
    f"""WITH {shared.sql_near(TOP)}, {ALLOWED}
SELECT query_id, rank, id, distance FROM (
  SELECT query_id, id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
  FROM gaps WHERE id IN (SELECT id FROM allowed)) WHERE rank <= {TOP}""",
)
def filtered_search_semantic(spark, folder):
    """The nearest posts among those that pass the filter, by vector."""
    queries = shared.encode_queries(shared.benchmark_queries(spark, folder))
    allowed = metadata_filter(spark, folder).select("id")
    return semantic.nearest(shared.corpus_pivots(spark, folder), queries, TOP, allowed)


@query(
    "g7_text_chunks",
    f"""WITH split AS (
  SELECT doc_id AS id, string_split({shared.sql_squeeze('text')}, ' ') AS w FROM documents WHERE {shared.sql_squeeze('text')} <> ''),
numbered AS (SELECT id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 50) / 40), 0) AS BIGINT) + 1)) AS chunk FROM split)
SELECT id, chunk, array_to_string(list_slice(w, chunk * 40 + 1, chunk * 40 + 50), ' ') AS text FROM numbered""",
)
def text_chunks(spark, folder):
    parts = rerank.chunks(posts_from_documents(spark, folder, ("id", "content"), busy=True), 50, 40)
    return parts.select("id", F.col("chunk").cast("long").alias("chunk"), "text")


@query(
    "g8_best_per_place",
    f"""WITH {shared.sql_hits(TOP)}
SELECT query_id, location_name, id, score, posts FROM (
  SELECT query_id, location_name, p.id, score, count(*) OVER (PARTITION BY query_id, location_name) AS posts,
         row_number() OVER (PARTITION BY query_id, location_name ORDER BY score DESC, p.id) AS n
  FROM hits h JOIN posts p ON p.id = h.id) WHERE n = 1""",
)
def best_per_place(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url", "location_name"))
    return rerank.best_per_place(attach_posts(_lexical(spark, folder, TOP), posts, key="id"))


def _respelled(place):
    """Place names as different writers spell them."""
    return (
        F.when(F.col("id") % 5 == 1, F.translate(place, "AEO", "ÁÉÖ"))
        .when(F.col("id") % 5 == 2, F.lower(place))
        .when((F.col("id") % 5 == 3) & (F.char_length(place) > 6), F.substring(place, F.lit(1), F.char_length(place) - 1))
        .otherwise(place)
    )


RESPELLED = """
spelled AS (
  SELECT id, CASE WHEN id % 5 = 1 THEN translate(location_name, 'AEO', 'ÁÉÖ') WHEN id % 5 = 2 THEN lower(location_name)
    WHEN id % 5 = 3 AND length(location_name) > 6 THEN left(location_name, length(location_name) - 1) ELSE location_name END AS location_name
  FROM posts),
folds AS (SELECT DISTINCT location_name, strip_accents(lower(location_name)) AS f FROM spelled),
f AS (SELECT DISTINCT f FROM folds),
links AS (SELECT a.f AS a, b.f AS b FROM f a JOIN f b ON a.f = b.f OR
  (length(a.f) >= 5 AND length(b.f) >= 5 AND abs(length(a.f) - length(b.f)) <= 1 AND levenshtein(a.f, b.f) <= 1)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
alike AS (SELECT location_name, min(b) AS place FROM folds JOIN reach ON a = f GROUP BY location_name)"""


def _spelled(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url", "location_name"))
    return posts.withColumn("location_name", _respelled(F.col("location_name")))


@query("g8_places_alike", f"WITH RECURSIVE {shared.POSTS}, {RESPELLED} SELECT location_name, place FROM alike")
def places_alike(spark, folder):
    return variety.places_alike(_spelled(spark, folder))


@query(
    "g8_best_per_alike_place",
    f"""WITH RECURSIVE {shared.sql_hits(TOP)}, {RESPELLED}
SELECT query_id, place, id, score, posts FROM (
  SELECT query_id, place, s.id, score, count(*) OVER (PARTITION BY query_id, place) AS posts,
         row_number() OVER (PARTITION BY query_id, place ORDER BY score DESC, s.id) AS n
  FROM hits h JOIN spelled s ON s.id = h.id JOIN alike USING (location_name)) WHERE n = 1""",
)
def best_per_alike_place(spark, folder):
    posts = _spelled(spark, folder)
    found = attach_posts(_lexical(spark, folder, TOP), posts, key="id")
    return variety.best_per_alike_place(found, variety.places_alike(posts))


@query("g8_varied_hits")
def varied_hits(spark, folder):
    """Hits by marginal relevance among the best fifty; compared with brute force in the tests."""
    posts = posts_from_documents(spark, folder, ("id", "page_url", "location_name"))
    found = attach_posts(_lexical(spark, folder, variety.CANDIDATES), posts, key="id")
    known = found.join(shared.corpus_vectors(spark, folder), "id").withColumn("place", variety.folded(F.col("location_name")))
    return variety.varied(known, FUSED)


CHANGES = """
days AS (SELECT event_type, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1, 2),
marks AS (SELECT event_type, d, n, n AS delta FROM days UNION ALL SELECT event_type, d + INTERVAL 1 DAY, 0, -n FROM days),
changes AS (SELECT event_type, d, CAST(sum(n) AS BIGINT) AS n, CAST(sum(delta) AS BIGINT) AS trend_delta FROM marks GROUP BY 1, 2)
SELECT event_type, strftime(d, '%Y-%m-%d') AS day, n, trend_delta FROM changes"""


def _by_day(changes):
    return changes.select(
        "event_type", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", "trend_delta"
    )


def _sparse(events):
    """Every third day without events of the types with an even number of letters."""
    return events.filter((F.char_length("event_type") % 2 == 1) | (F.dayofyear("ts") % 3 != 0))


SPARSE_EVENTS = """events AS (
  SELECT ts, event_type FROM main.events WHERE length(event_type) % 2 = 1 OR dayofyear(ts) % 3 <> 0)"""


@query("g9_trend_change", f"WITH {CHANGES} WHERE d <= (SELECT max(ts) FROM events)")
def trend_change(spark, folder):
    return _by_day(rerank.activity_change(table(spark, folder, "events"), "ts", "event_type", "1 day"))


@query("g9_trend_falls", f"WITH {SPARSE_EVENTS}, {CHANGES} WHERE d <= (SELECT max(ts) FROM events)")
def trend_falls(spark, folder):
    """Places whose activity falls to nothing give a row of their own."""
    return _by_day(rerank.activity_change(_sparse(table(spark, folder, "events")), "ts", "event_type", "1 day"))


def _streamed(spark, folder, late):
    events = table(spark, folder, "events")
    # As a pattern, the location may be a single file as well as a folder of files.
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events[.]parquet")
    path = work_path(spark, "changes")
    changes = activity_change_stream(stream, "ts", "event_type", "1 day", late=late)
    (
        changes.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", work_path(spark, "progress"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _by_day(spark.read.schema(changes.schema).parquet(path))


@query(
    "g9_trend_change_stream",
    f"WITH {CHANGES} WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)",
)
def trend_change_stream(spark, folder):
    """The same on a stream; the last windows stay open until later events close them."""
    return _streamed(spark, folder, "2 days")


@query(
    "g9_trend_change_stream_short",
    f"WITH {CHANGES} WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)",
)
def trend_change_stream_short(spark, folder):
    """Events may be late by less than a window."""
    return _streamed(spark, folder, "2 hours")
