"""Result records and searches from end to end: C11, D8, D9, E1 to E15, A9."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.operators import hits as hx
from placeseek.operators import search
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.session import work_path
from placeseek.sources import files
from placeseek.sources.tables import posts_from_documents

TOP = 12
FEW = 5

FLAT = ["query_id", "rank", "id", "destination", "country", "lat", "lon", "score", "distance",
        "snippets", "page_title", "page_url", "blog_url", "author", "description",
        "content_preview", "full_content"]


def _asked(spark, folder, k=TOP, model="bm25"):
    return shared.benchmark_queries(spark, folder).select(
        "query_id", "query", F.lit(model).alias("model"), F.lit(k).alias("k")
    )


def _flat(shaped):
    """Snippets as one text, bodies as digests, so that rows compare as plain values."""
    return shaped.select(
        *[c for c in FLAT if c not in ("snippets", "full_content")],
        F.array_join("snippets", " | ").alias("snippets"),
        F.md5("full_content").alias("full_content"),
    )


SHOWN = "floor({} * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE"
PREVIEW = "substr(content, 1, 300) || CASE WHEN length(content) > 300 THEN '...' ELSE '' END"
COUNTRY = ("CASE WHEN location_name IS NULL OR strpos(location_name, ',') = 0 THEN '' "
           "ELSE trim(string_split(location_name, ',')[-1]) END")


def sql_flat(source: str, lexical: bool) -> str:
    """Flat record of ``source`` rows joined to posts."""
    if lexical:
        place, lat, lon = "coalesce(location_name, 'Unknown')", "nullif(latitude, 0)", "nullif(longitude, 0)"
        score, distance = SHOWN.format("score"), "CAST(NULL AS DOUBLE)"
    else:
        place, lat, lon = "location_name", "latitude", "longitude"
        score, distance = "CAST(NULL AS DOUBLE)", SHOWN.format("distance")
    return f"""
SELECT query_id, rank, h.id, {place} AS destination, {COUNTRY} AS country, {lat} AS lat, {lon} AS lon,
       {score} AS score, {distance} AS distance,
       array_to_string(list_filter([page_description, {PREVIEW}], lambda x: x <> ''), ' | ') AS snippets,
       page_title, page_url, blog_url, coalesce(page_author, '') AS author, page_description AS description,
       {PREVIEW} AS content_preview, md5(content) AS full_content
FROM {source} h JOIN posts p ON p.id = h.id"""


@query("c11_lexical_search", f"WITH {shared.sql_hits(TOP)} {sql_flat('hits', True)}")
def lexical_search(spark, folder):
    found = search.lexical_hits(shared.collection(spark, folder), _asked(spark, folder))
    return _flat(found)


@query("d9_semantic_search", f"WITH {shared.sql_near(TOP)} {sql_flat('near', False)}")
def semantic_search(spark, folder):
    asked = _asked(spark, folder, model="faiss")
    return _flat(search.semantic_hits(shared.collection(spark, folder), asked))


@query(
    "d8_blank_queries",
    f"""WITH {shared.sql_near(FEW)}
SELECT query_id, rank, id, distance FROM near JOIN queries q USING (query_id) WHERE length(q.query) % 2 = 0""",
)
def blank_queries(spark, folder):
    """Every other query text replaced by blanks; those must find nothing."""
    blank = F.when(F.char_length("query") % 2 == 0, F.col("query")).otherwise(" \t\n\u3000 ")
    asked = _asked(spark, folder, FEW, "faiss").withColumn("query", blank)
    found = search.semantic_hits(shared.collection(spark, folder), asked)
    from placeseek.operators import semantic

    encoded = search.encode_queries(asked.filter(F.col("query").rlike(r"[^\s\u3000]")))
    ranked = semantic.nearest(shared.corpus_vectors(spark, folder), encoded, FEW)
    return found.select("query_id", "rank", "id").join(ranked, ["query_id", "rank", "id"])


def _places(spark, folder):
    return posts_from_documents(
        spark, folder, ("id", "location_name", "latitude", "longitude", "page_description", "content")
    )


@query("e1_country", f"WITH {shared.POSTS} SELECT id, {COUNTRY} AS country FROM posts")
def country(spark, folder):
    return _places(spark, folder).select("id", vx.country(F.col("location_name")).alias("country"))


@query("e2_preview", f"WITH {shared.POSTS} SELECT id, {PREVIEW} AS preview FROM posts")
def preview(spark, folder):
    return _places(spark, folder).select("id", tx.preview(F.col("content")).alias("preview"))


@query(
    "e3_snippet",
    f"""WITH {shared.POSTS}
SELECT id, replace(substr(content, 1, 300), chr(10), ' ') || '...' AS snippet FROM posts""",
)
def snippet(spark, folder):
    return _places(spark, folder).select("id", tx.snippet(F.col("content")).alias("snippet"))


@query(
    "e4_coordinates",
    f"""WITH {shared.POSTS}
SELECT id, nullif(latitude, 0) AS lexical_lat, nullif(longitude, 0) AS lexical_lon, latitude, longitude FROM posts""",
)
def coordinates(spark, folder):
    lat, lon = F.col("latitude"), F.col("longitude")
    return _places(spark, folder).select(
        "id",
        vx.coordinate(lat, zero_is_missing=True).alias("lexical_lat"),
        vx.coordinate(lon, zero_is_missing=True).alias("lexical_lon"),
        vx.coordinate(lat).alias("latitude"),
        vx.coordinate(lon).alias("longitude"),
    )


@query(
    "e5_snippets",
    f"""WITH {shared.POSTS}
SELECT id, len(s) AS n, array_to_string(s, ' | ') AS snippets
FROM (SELECT id, list_filter([page_description, {PREVIEW}], lambda x: x <> '') AS s FROM posts)""",
)
def snippets(spark, folder):
    both = hx.snippets(F.col("page_description"), tx.preview(F.col("content")))
    return _places(spark, folder).select("id", both.alias("s")).select(
        "id", F.size("s").cast("long").alias("n"), F.array_join("s", " | ").alias("snippets")
    )


@query(
    "e6_rounded_scores",
    f"WITH {shared.sql_hits(FEW)} SELECT query_id, id, {SHOWN.format('score')} AS score FROM hits",
)
def rounded_scores(spark, folder):
    found = search.lexical_hits(shared.collection(spark, folder), _asked(spark, folder, FEW))
    return found.select("query_id", "id", "score")


@query(
    "e7_provenance",
    f"""WITH {shared.sql_hits(FEW)}
SELECT query_id, h.id, 'BM25' AS model, page_title, page_url, blog_url, coalesce(page_author, '') AS author
FROM hits h JOIN posts p ON p.id = h.id""",
)
def provenance(spark, folder):
    found = search.lexical_hits(shared.collection(spark, folder), _asked(spark, folder, FEW))
    return hx.records(found, hx.LEXICAL).select("query_id", "id", "why.*")


@query(
    "e8_unknown_place",
    f"""WITH {shared.sql_hits(FEW)}
SELECT query_id, h.id, CASE WHEN length(content) % 3 = 0 THEN 'Unknown' ELSE location_name END AS destination
FROM hits h JOIN posts p ON p.id = h.id""",
)
def unknown_place(spark, folder):
    """Posts of some text lengths lose their place; their hits read Unknown."""
    whole = shared.collection(spark, folder)
    lost = whole.posts.withColumn(
        "location_name", F.when(F.char_length("content") % 3 != 0, F.col("location_name"))
    )
    partial = search.Collection(lost, whole.index, whole.vectors, whole.encode)
    found = search.lexical_hits(partial, _asked(spark, folder, FEW))
    return found.select("query_id", "id", "destination")


def _mixed(spark, folder):
    """Models by query length: half lexical, a quarter semantic, the rest invalid."""
    turn = F.char_length("query") % 4
    model = F.when(turn < 2, "bm25").when(turn == 2, "faiss").otherwise("attribute+context")
    return _asked(spark, folder, FEW).withColumn("model", model)


MIXED = """
routed AS (
  SELECT query_id, CASE WHEN length(query) % 4 < 2 THEN 'bm25' WHEN length(query) % 4 = 2 THEN 'faiss'
         ELSE 'attribute+context' END AS model FROM queries)"""


def _both_sql(tail: str) -> str:
    lexical = shared.sql_hits(FEW).strip()
    vectors = shared.sql_near(FEW)
    rest = vectors[vectors.index("keys AS (") :]
    return f"WITH {lexical}, {rest}, {MIXED} {tail}"


@query(
    "e10_routed_search",
    _both_sql(
        f"""SELECT * FROM (SELECT r.model, f.* FROM ({sql_flat('hits', True)}) f JOIN routed r USING (query_id) WHERE r.model = 'bm25')
UNION ALL SELECT * FROM (SELECT r.model, f.* FROM ({sql_flat('near', False)}) f JOIN routed r USING (query_id) WHERE r.model = 'faiss')"""
    ),
)
def routed_search(spark, folder):
    found = search.search(shared.collection(spark, folder), search.valid(_mixed(spark, folder)))
    return _flat(found).join(_mixed(spark, folder).select("query_id", "model"), "query_id")


@query(
    "e10_rejected_models",
    f"WITH {shared.BENCHMARK_QUERIES}, {MIXED} SELECT query_id, model FROM routed WHERE model NOT IN ('bm25', 'faiss')",
)
def rejected_models(spark, folder):
    return search.rejected(_mixed(spark, folder)).select("query_id", "model")


@query(
    "e11_responses",
    _both_sql(
        """SELECT r.query_id, r.model AS model_used, CAST(5 AS INTEGER) AS k, string_agg(CAST(x.id AS VARCHAR), ',' ORDER BY rank) AS ids,
  CASE WHEN length(q.query) % 2 = 0 THEN count(*) FILTER (WHERE rank <= 3) ELSE 0 END AS explanations
FROM routed r JOIN queries q USING (query_id)
JOIN (SELECT 'bm25' AS model, query_id, rank, id FROM hits UNION ALL SELECT 'faiss', query_id, rank, id FROM near) x
  ON x.query_id = r.query_id AND x.model = r.model
GROUP BY r.query_id, r.model, q.query"""
    ),
)
def responses(spark, folder):
    """Nested responses, flattened to the ids in order and the number of explanations."""
    asked = _mixed(spark, folder).withColumn("explain", F.char_length("query") % 2 == 0)
    out = search.responses(shared.collection(spark, folder), asked)
    return out.select(
        "query_id",
        F.col("params.model_used").alias("model_used"),
        F.col("params.retrieval.k").alias("k"),
        F.array_join(F.transform("results", lambda r: r["id"].cast("string")), ",").alias("ids"),
        F.size("explanations").cast("long").alias("explanations"),
    )


@query(
    "e12_rank_numbers",
    f"""WITH {shared.sql_hits(FEW)} SELECT query_id, id,
row_number() OVER (PARTITION BY query_id ORDER BY {SHOWN.format('score')} DESC, id) AS rank FROM hits""",
)
def rank_numbers(spark, folder):
    found = search.lexical_hits(shared.collection(spark, folder), _asked(spark, folder, FEW))
    return hx.numbered(found.drop("rank")).select("query_id", "id", "rank")


@query(
    "e13_composed_query",
    f"""WITH {shared.POSTS}
SELECT id, trim(page_title || '. ' || page_description || '. ' || location_name) AS query FROM posts""",
)
def composed_query(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_title", "page_description", "location_name"))
    return posts.select(
        "id",
        tx.compose_query(F.col("page_title"), F.col("page_description"), F.col("location_name")).alias("query"),
    )


PROMPT = """trim('Explain to a traveller why this place fits their request.' || chr(10) || 'Request: ' || query
|| chr(10) || 'Article: ' || content || chr(10) || 'Name the place exactly. Use at most 8 sentences.')"""


@query(
    "e14_prompts",
    f"""WITH {shared.sql_hits(FEW)}
SELECT query_id, h.id, md5({PROMPT}) AS prompt, length({PROMPT}) AS size
FROM hits h JOIN posts p ON p.id = h.id JOIN queries USING (query_id)""",
)
def prompts(spark, folder):
    asked = _asked(spark, folder, FEW)
    found = search.lexical_hits(shared.collection(spark, folder), asked).join(
        asked.select("query_id", "query"), "query_id"
    )
    text = hx.prompt(F.col("query"), F.col("full_content"))
    return found.select("query_id", "id", F.md5(text).alias("prompt"), F.char_length(text).cast("long").alias("size"))


@query(
    "e15_explanations",
    f"""WITH {shared.sql_hits(FEW)}
SELECT query_id, rank, h.id, replace(substr(content, 1, 300), chr(10), ' ') || '...' AS explanation
FROM hits h JOIN posts p ON p.id = h.id JOIN queries q USING (query_id)
WHERE rank <= 3 AND length(q.query) % 2 = 0""",
)
def explanations(spark, folder):
    asked = _asked(spark, folder, FEW).withColumn("explain", F.char_length("query") % 2 == 0)
    found = search.lexical_hits(shared.collection(spark, folder), asked)
    return hx.explained(found, asked)


def _length_or_failure(prompt):
    if len(prompt) % 2:
        raise RuntimeError("no answer")
    return f"{len(prompt)} letters"


@query(
    "e15_failing_generator",
    f"""WITH {shared.sql_hits(FEW)}
SELECT query_id, rank, h.id,
       CASE WHEN length({PROMPT}) % 2 = 1 THEN 'Explanation unavailable.' ELSE length({PROMPT}) || ' letters' END AS explanation
FROM hits h JOIN posts p ON p.id = h.id JOIN queries q USING (query_id) WHERE rank <= 3""",
)
def failing_generator(spark, folder):
    """A generator that fails for some prompts: those hits get the fixed text, the others their own."""
    asked = _asked(spark, folder, FEW).withColumn("explain", F.lit(True))
    found = search.lexical_hits(shared.collection(spark, folder), asked)
    return hx.explained(found, asked, hx.generator(_length_or_failure))


@query(
    "f7_result_summary",
    f"""WITH {shared.sql_hits(TOP)}
SELECT query_id, count(*) AS hits, round(avg({SHOWN.format('score')}), 6) AS mean_score, CAST(NULL AS DOUBLE) AS mean_distance
FROM hits GROUP BY query_id""",
)
def result_summary(spark, folder):
    found = search.lexical_hits(shared.collection(spark, folder), _asked(spark, folder))
    return hx.summary(found).select(
        "query_id", "hits", F.round("mean_score", 6).alias("mean_score"), "mean_distance"
    )


@query(
    "f7_result_summary_semantic",
    f"""WITH {shared.sql_near(TOP)}
SELECT query_id, count(*) AS hits, CAST(NULL AS DOUBLE) AS mean_score,
       CASE WHEN sum({SHOWN.format('distance')}) > 0 THEN round(avg({SHOWN.format('distance')}), 6) END AS mean_distance
FROM near GROUP BY query_id""",
)
def result_summary_semantic(spark, folder):
    found = search.semantic_hits(shared.collection(spark, folder), _asked(spark, folder, model="faiss"))
    return hx.summary(found).select(
        "query_id", "hits", "mean_score", F.round("mean_distance", 6).alias("mean_distance")
    )


MAPPED = f"""
points AS (
  SELECT query_id, h.id, latitude AS lat, longitude AS lon, {SHOWN.format('distance')} AS value
  FROM near h JOIN posts p ON p.id = h.id WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""


def _points(spark, folder):
    asked = _asked(spark, folder, model="faiss")
    return hx.mappable(search.semantic_hits(shared.collection(spark, folder), asked))


@query(
    "f8_mappable_hits",
    f"WITH {shared.sql_near(TOP)}, {MAPPED} SELECT query_id, id, lat, lon, value FROM points",
)
def mappable_hits(spark, folder):
    return _points(spark, folder).select("query_id", "id", "lat", "lon", "value")


@query(
    "f9_relative_colours",
    f"""WITH {shared.sql_near(TOP)}, {MAPPED},
ends AS (SELECT query_id, min(value) AS low, CASE WHEN max(value) <> min(value) THEN max(value) - min(value) ELSE 1 END AS spread FROM points GROUP BY query_id),
shares AS (SELECT query_id, id, 1 - (value - low) / spread AS share FROM points JOIN ends USING (query_id))
SELECT query_id, id, round(share, 6) AS share, CAST(floor(255 * (1 - share)) AS INTEGER) AS red, CAST(floor(255 * share) AS INTEGER) AS green FROM shares""",
)
def relative_colours(spark, folder):
    return hx.coloured(_points(spark, folder)).select(
        "query_id", "id", F.round("share", 6).alias("share"), "red", "green"
    )


@query(
    "a9_ranked_export",
    f"""WITH {shared.sql_hits(TOP)}
SELECT query_id, score AS "Score", location_name AS "Location Name", page_title AS "Page Title",
       longitude AS "Longitude", latitude AS "Latitude"
FROM hits h JOIN posts p ON p.id = h.id""",
)
def ranked_export(spark, folder):
    """All ranked hits written as the export file and read back."""
    whole = shared.collection(spark, folder)
    asked = _asked(spark, folder)
    from placeseek.operators import lexical

    found = hx.attach_posts(lexical.search(whole.index, asked, TOP), whole.posts)
    path = work_path(spark, "ranked")
    files.write_ranked(found, path)
    return files.read_ranked(spark, path)
