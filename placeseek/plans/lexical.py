"""Ranking by text: queries C1 to C12 and the batch run A10."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.operators import lexical
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.session import work_path
from placeseek.sources.tables import table

TOP = 12
BATCH_TOP = 5
THREE_TERMS = "the est and"


def _one(spark, folder, text):
    """A single fixed query over the whole collection."""
    return table(spark, folder, "region").agg(
        F.lit(0).cast("long").alias("query_id"), F.max(F.lit(text)).alias("query")
    ).select("query_id", "query")


@query(
    "c1_tokens",
    f"""WITH {shared.POSTS}, {shared.TEXTS}
SELECT doc_id, len(x) AS n_tokens, coalesce(x[1], '') AS first_token, coalesce(x[-1], '') AS last_token,
       md5(array_to_string(x, ' ')) AS digest
FROM (SELECT doc_id, {shared.sql_tokens('t')} AS x FROM texts)""",
)
def tokens(spark, folder):
    docs = shared.searchable(spark, folder).select("doc_id", tx.tokens(F.col("text")).alias("x"))
    return docs.select(
        "doc_id",
        F.size("x").cast("long").alias("n_tokens"),
        F.coalesce(F.try_element_at("x", F.lit(1)), F.lit("")).alias("first_token"),
        F.coalesce(F.try_element_at("x", F.lit(-1)), F.lit("")).alias("last_token"),
        F.md5(F.array_join("x", " ")).alias("digest"),
    )


@query("c2_term_frequency", f"WITH {shared.INDEX} SELECT doc_id, term, tf FROM tf")
def term_frequency(spark, folder):
    return shared.corpus_index(spark, folder).postings.select("doc_id", "term", "tf")


@query("c3_document_length", f"WITH {shared.INDEX} SELECT doc_id, dl FROM dl")
def document_length(spark, folder):
    return shared.corpus_index(spark, folder).documents


@query(
    "c3_mean_length",
    f"WITH {shared.INDEX} SELECT n, total_len, round(avgdl, 6) AS avgdl FROM corpus",
)
def mean_length(spark, folder):
    corpus = shared.corpus_index(spark, folder).corpus
    mean = F.col("total_len") / F.nullif(F.col("n"), F.lit(0))
    return corpus.select("n", "total_len", F.round(mean, 6).alias("avgdl"))


@query("c4_document_frequency", f"WITH {shared.INDEX} SELECT term, df FROM df")
def document_frequency(spark, folder):
    return shared.corpus_index(spark, folder).terms.select("term", "df")


def _weights(spark, folder, form):
    index = shared.corpus_index(spark, folder)
    weighted = lexical.weighted_terms(index.terms, index, form)
    return weighted.select("term", F.round("idf", 6).alias("idf"))


@query(
    "c5_idf_smoothed",
    f"WITH {shared.INDEX}, {shared.SMOOTHED_IDF} SELECT term, round(idf, 6) AS idf FROM idf",
)
def idf_smoothed(spark, folder):
    return _weights(spark, folder, lexical.SMOOTHED)


@query(
    "c7_idf_floored",
    f"WITH {shared.INDEX}, {shared.FLOORED_IDF} SELECT term, round(idf, 6) AS idf FROM idf",
)
def idf_floored(spark, folder):
    return _weights(spark, folder, lexical.FLOORED)


def _search(spark, folder, queries, k, form):
    found = lexical.search(shared.corpus_index(spark, folder), queries, k, form)
    return found.select("query_id", "rank", F.col("doc_id").alias("id"), "score")


def _hits_sql(k, idf, queries):
    return f"WITH {shared.sql_hits(k, idf, queries)} SELECT query_id, rank, id, score FROM hits"


@query(
    "c6_bm25_smoothed",
    _hits_sql(TOP, shared.SMOOTHED_IDF, shared.fixed_query(THREE_TERMS)),
)
def bm25_smoothed(spark, folder):
    return _search(spark, folder, _one(spark, folder, THREE_TERMS), TOP, lexical.SMOOTHED)


@query(
    "c7_bm25_floored",
    _hits_sql(TOP, shared.FLOORED_IDF, shared.fixed_query(THREE_TERMS)),
)
def bm25_floored(spark, folder):
    return _search(spark, folder, _one(spark, folder, THREE_TERMS), TOP, lexical.FLOORED)


@query(
    "c8_top_with_zero_scores",
    _hits_sql(TOP, shared.SMOOTHED_IDF, shared.fixed_query("nosuchwordanywhere")),
)
def top_with_zero_scores(spark, folder):
    return _search(
        spark, folder, _one(spark, folder, "nosuchwordanywhere"), TOP, lexical.SMOOTHED
    )


@query(
    "c9_blank_queries",
    _hits_sql(
        BATCH_TOP,
        shared.FLOORED_IDF,
        "queries AS (SELECT item_id AS query_id, CASE WHEN length(text) % 2 = 0 THEN text ELSE '  ?! ' END AS query "
        "FROM benchmark)",
    ),
)
def blank_queries(spark, folder):
    """Every other query text replaced by marks only; those must find nothing."""
    asked = shared.benchmark_queries(spark, folder)
    blank = F.when(F.char_length("query") % 2 == 0, F.col("query")).otherwise("  ?! ")
    return _search(spark, folder, asked.withColumn("query", blank), BATCH_TOP, lexical.FLOORED)


@query(
    "c10_lookup_by_text",
    "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents",
)
def lookup_by_text(spark, folder):
    return lexical.resolve_by_text(table(spark, folder, "documents").select("doc_id", "text"))


@query(
    "c12_index_postings",
    f"WITH {shared.INDEX} SELECT term, doc_id, tf, dl FROM tf JOIN dl USING (doc_id)",
)
def index_postings(spark, folder):
    return shared.corpus_index(spark, folder).postings.select("term", "doc_id", "tf", "dl")


@query("c12_index_grown", f"WITH {shared.INDEX} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS n, CAST(sum(tf * dl) AS BIGINT) AS mass FROM tf JOIN dl USING (doc_id) GROUP BY term")
def index_grown(spark, folder):
    """An index appended to twice and merged, summed per term."""
    docs, path = shared.searchable(spark, folder), work_path(spark, "grown")
    for part in range(3):
        lexical.append_index(docs.filter(F.col("doc_id") % 3 == part), path)
    index = lexical.compact(spark, path, fan=3)
    sums = index.postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("found"), F.sum("tf").alias("n"), F.sum(F.col("tf") * F.col("dl")).alias("mass")
    )
    # The stored frequencies must be those of the postings.
    return sums.join(index.terms, "term").filter("found = df").select("term", "df", "n", "mass")


@query("a10_batch_search", _hits_sql(BATCH_TOP, shared.FLOORED_IDF, shared.BENCHMARK_QUERIES))
def batch_search(spark, folder):
    return _search(
        spark, folder, shared.benchmark_queries(spark, folder), BATCH_TOP, lexical.FLOORED
    )


@query(
    "a10_batch_search_smoothed",
    _hits_sql(BATCH_TOP, shared.SMOOTHED_IDF, shared.BENCHMARK_QUERIES),
)
def batch_search_smoothed(spark, folder):
    return _search(
        spark, folder, shared.benchmark_queries(spark, folder), BATCH_TOP, lexical.SMOOTHED
    )
