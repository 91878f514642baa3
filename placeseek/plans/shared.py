"""Inputs that several queries share, and the SQL text of the same inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.operators import lexical, semantic
from placeseek.operators.gazetteer import WORD_OR_MARK
from placeseek.operators.search import Collection, encode_queries
from placeseek.session import stored, work_path
from placeseek.sources.tables import posts_from_documents, table

# -- held between searches, as a service would: built once per data version ------------

_held: dict[tuple, object] = {}


def _version(spark: SparkSession, folder: str, names: tuple[str, ...]) -> tuple:
    """Session, place, size and age of the files, without reading them."""
    files = [f"{folder}/{name}.parquet" for name in names]
    row = (
        spark.read.format("binaryFile")
        .load(files)
        .agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"))
        .first()
    )
    return (spark.sparkContext.applicationId, folder, *row)


def searchable(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text): what the index and the encoder read of each post."""
    columns = ("id", "page_title", "page_description", "content")
    posts = posts_from_documents(spark, folder, columns, busy=True)
    whole = tx.search_text(F.col("page_title"), F.col("page_description"), F.col("content"))
    return posts.select(F.col("id").alias("doc_id"), whole.alias("text"))


def corpus_index(spark: SparkSession, folder: str) -> lexical.LexicalIndex:
    key = ("index", *_version(spark, folder, ("documents",)))
    if key not in _held:
        _held[key] = lexical.build_index(searchable(spark, folder), work_path(spark, "index"))
    return _held[key]


def corpus_vectors(spark: SparkSession, folder: str) -> DataFrame:
    key = ("vectors", *_version(spark, folder, ("documents",)))
    if key not in _held:
        encoded = semantic.encode_hashed(searchable(spark, folder), "text", ["doc_id"])
        _held[key] = stored(encoded.withColumnRenamed("doc_id", "id"), "vectors")
    return _held[key]


def corpus_pivots(spark: SparkSession, folder: str) -> semantic.PivotIndex:
    key = ("pivots", *_version(spark, folder, ("documents",)))
    if key not in _held:
        _held[key] = semantic.build_pivots(corpus_vectors(spark, folder), work_path(spark, "pivots"))
    return _held[key]


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    """(query_id, query): every benchmark text as a query."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").cast("long").alias("query_id"), F.col("text").alias("query")
    )


def collection(spark: SparkSession, folder: str) -> Collection:
    key = ("collection", *_version(spark, folder, ("documents", "labels", "nation", "region")))
    if key not in _held:
        _held[key] = Collection(
            posts_from_documents(spark, folder),
            corpus_index(spark, folder),
            corpus_pivots(spark, folder),
            encode_queries,
        )
    return _held[key]


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """(name, lat, lon): the longer words and the opening word pairs of the benchmark."""
    words = table(spark, folder, "benchmark").select(tx.tokens(F.col("text")).alias("w"))
    single = words.select(F.explode("w").alias("name")).filter(F.char_length("name") >= 5)
    pairs = words.filter(F.size("w") >= 2).select(
        F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1))).alias("name")
    )
    # Names of five and nine pieces: openings of some titles.
    titles = table(spark, folder, "documents").filter("doc_id % 29 = 0").select(
        F.regexp_extract_all(F.lower(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit(WORD_OR_MARK), F.lit(0)).alias("w"),
        F.when(F.col("doc_id") % 2 == 0, 5).otherwise(9).alias("n"),
    )
    openings = titles.filter(F.size("w") >= F.col("n")).select(F.array_join(F.slice("w", 1, F.col("n")), " ").alias("name"))
    size = F.char_length("name")
    return (
        single.unionByName(pairs).unionByName(openings)
        .distinct()
        .select(
            "name",
            (size * 13 % 180 - 90).cast("double").alias("lat"),
            (size * 29 % 360 - 180).cast("double").alias("lon"),
        )
    )


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """(term, weight): words of the benchmark, weighted by their length."""
    return (
        table(spark, folder, "benchmark")
        .select(F.explode(tx.tokens(F.col("text"))).alias("term"))
        .distinct()
        .select("term", (F.char_length("term") % 5 / 2.0 - 1.0).alias("weight"))
    )


# -- the same in SQL ---------------------------------------------------------------------

POSTS = r"""
posts AS (
  SELECT d.doc_id AS id, d.source AS blog_url,
         'https://' || d.source || '.example.com/' || CAST(d.doc_id % 900 AS VARCHAR) || '/' AS page_url,
         split_part(d.text, chr(10), 1) AS page_title,
         split_part(d.text, chr(10), 2) AS page_description,
         CASE WHEN l.doc_id IS NOT NULL THEN 'author_' || CAST(d.doc_id % 97 AS VARCHAR) END AS page_author,
         CASE WHEN d.doc_id % 7 = 0 THEN n.n_name ELSE n.n_name || ', ' || r.r_name END AS location_name,
         CASE WHEN n.n_nationkey % 11 <> 10 THEN CAST(n.n_nationkey * 37 % 181 - 90 AS DOUBLE) END AS latitude,
         CASE WHEN n.n_nationkey % 11 <> 10 THEN CAST(n.n_nationkey * 91 % 361 - 180 AS DOUBLE) END AS longitude,
         d.text AS content
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN nation n ON n.n_nationkey = d.doc_id % 25
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

TEXTS = """
texts AS (SELECT id AS doc_id, page_title || ' ' || page_description || ' ' || content AS t FROM posts)"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{tx.SPACES}', ' ', 'g'))"


def sql_clean(x: str) -> str:
    x = f"translate({x}, {sql_text(tx.CURLY)}, {sql_text(tx.STRAIGHT)})"
    x = f"regexp_replace({x}, '{tx.SPACES}', ' ', 'g')"
    x = f"translate({x}, {sql_text(tx.DELETED)}, '')"
    x = f"replace(replace(replace({x}, '&', 'and'), '@', 'at'), '-', ' ')"
    return sql_squeeze(f"lower({x})")


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{tx.WORD}')"


INDEX = f"""
{POSTS}, {TEXTS},
tokens AS (SELECT doc_id, unnest({sql_tokens('t')}) AS term FROM texts),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
dl AS MATERIALIZED (SELECT x.doc_id, CAST(coalesce(sum(tf), 0) AS BIGINT) AS dl FROM texts x LEFT JOIN tf USING (doc_id) GROUP BY x.doc_id),
df AS MATERIALIZED (SELECT term, count(*) AS df FROM tf GROUP BY term),
corpus AS (SELECT count(*) AS n, CAST(sum(dl) AS BIGINT) AS total_len, avg(dl) AS avgdl FROM dl)"""

SMOOTHED_IDF = "idf AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM df, corpus)"
FLOORED_IDF = """
raw AS MATERIALIZED (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS v FROM df, corpus),
idf AS (SELECT term, CASE WHEN v < 0 THEN 0.25 * (SELECT avg(v) FROM raw) ELSE v END AS idf FROM raw)"""

BENCHMARK_QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def fixed_query(text: str) -> str:
    return f"queries AS (SELECT CAST(0 AS BIGINT) AS query_id, {sql_text(text)} AS query)"


def sql_hits(k: int, idf: str = FLOORED_IDF, queries: str = BENCHMARK_QUERIES) -> str:
    """Common table expressions up to ``hits(query_id, rank, id, score)``."""
    return f"""{INDEX}, {idf}, {queries},
asked AS (SELECT query_id, unnest({sql_tokens('query')}) AS term FROM queries),
scored AS (
  SELECT query_id, doc_id, sum(idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) AS s
  FROM asked JOIN idf USING (term) JOIN tf USING (term) JOIN dl USING (doc_id), corpus
  GROUP BY query_id, doc_id),
complete AS (
  SELECT q.query_id, d.doc_id, round(coalesce(s, 0), 6) AS score
  FROM (SELECT DISTINCT query_id FROM asked) q CROSS JOIN dl d
  LEFT JOIN scored USING (query_id, doc_id)),
hits AS (
  SELECT * FROM (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
           doc_id AS id, score FROM complete)
  WHERE rank <= {k})"""


ENCODER = """
slots AS (
  SELECT key, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS slot,
         sum(CASE WHEN CAST('0x' || substr(md5(term), 9, 1) AS BIGINT) < 8 THEN 1 ELSE -1 END) AS v
  FROM keyed GROUP BY 1, 2),
dense AS (
  SELECT k.key, s.slot, CAST(coalesce(v, 0) AS DOUBLE) AS v
  FROM keys k CROSS JOIN (SELECT unnest(range(64)) AS slot) s LEFT JOIN slots x ON x.key = k.key AND x.slot = s.slot),
lengths AS (SELECT key, greatest(sqrt(sum(v * v)), 1e-12) AS len FROM dense GROUP BY key),
encoded AS (SELECT key, list(v / len ORDER BY slot) AS vec FROM dense JOIN lengths USING (key) GROUP BY key)"""

# Keys: texts are ('d', id), queries are ('q', id).
BOTH_ENCODED = f"""{POSTS}, {TEXTS}, {BENCHMARK_QUERIES},
keys AS (SELECT 'd' || doc_id AS key FROM texts UNION ALL SELECT 'q' || query_id FROM queries),
keyed AS (
  SELECT 'd' || doc_id AS key, unnest({sql_tokens('t')}) AS term FROM texts
  UNION ALL SELECT 'q' || query_id, unnest({sql_tokens('query')}) FROM queries),
{ENCODER}"""


def sql_near(k: int) -> str:
    """Common table expressions up to ``near(query_id, rank, id, distance)``."""
    return f"""{BOTH_ENCODED},
gaps AS (
  SELECT CAST(substr(q.key, 2) AS BIGINT) AS query_id, CAST(substr(d.key, 2) AS BIGINT) AS id,
         round(greatest(list_inner_product(q.vec, q.vec) + list_inner_product(d.vec, d.vec)
               - 2 * list_inner_product(q.vec, d.vec), 0), 6) AS distance
  FROM encoded q JOIN encoded d ON q.key[1] = 'q' AND d.key[1] = 'd'),
near AS (
  SELECT * FROM (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank, id, distance
    FROM gaps) WHERE rank <= {k})"""


GAZETTEER = f"""
gwords AS (SELECT {sql_tokens('text')} AS w FROM benchmark),
gnames AS (
  SELECT DISTINCT name FROM (
    SELECT unnest(w) AS name FROM gwords) WHERE length(name) >= 5
  UNION SELECT w[1] || ' ' || w[2] FROM gwords WHERE len(w) >= 2
  UNION SELECT array_to_string(w[1:n], ' ') FROM (
    SELECT regexp_extract_all(lower(split_part(text, chr(10), 1)), '{WORD_OR_MARK}') AS w,
           CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 9 END AS n FROM documents WHERE doc_id % 29 = 0) WHERE len(w) >= n),
gazetteer AS (
  SELECT name, CAST(length(name) * 13 % 180 - 90 AS DOUBLE) AS lat,
         CAST(length(name) * 29 % 360 - 180 AS DOUBLE) AS lon FROM gnames)"""

LEXICON = f"""
lexicon AS (
  SELECT DISTINCT term, length(term) % 5 / 2.0 - 1.0 AS weight
  FROM (SELECT unnest({sql_tokens('text')}) AS term FROM benchmark))"""
