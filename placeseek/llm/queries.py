"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.llm import (
    centroids,
    decontamination,
    html_main,
    licenses,
    line_templates,
    matrices,
    ngram_join,
    one_bit_search,
    packing,
    resampling,
    secrets,
    tokens,
    toxicity,
    word_bpe,
)
from placeseek.llm.registry import ORACLES, QUERIES, query, table
from placeseek.session import stored

__all__ = ["ORACLES", "QUERIES"]


@query("op3_packed_matrices")
def op3_packed_matrices(spark: SparkSession, folder: str) -> DataFrame:
    return matrices.packed_matrices(table(spark, folder, "documents"), tokens.default_path())


@query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(table(spark, folder, "documents"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokens.default_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset")
    )


@query("op1_line_templates")
def op1_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.deduplicated(table(spark, folder, "documents")).select(
        "doc_id", "text", "n_lines", "n_dropped"
    )


@query("op2_benchmark_templates")
def op2_benchmark_templates(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_toxicity_chain")
def op7_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_html_main_text")
def op5_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_main.extracted(table(spark, folder, "pages"))


@query("op8_one_bit_search")
def op8_one_bit_search(spark: SparkSession, folder: str) -> DataFrame:
    indexed = stored(one_bit_search.index(table(spark, folder, "embeddings")), "codes")
    asked = indexed.filter("vec_id % 20 = 0").dropDuplicates(["vec_id"])
    return one_bit_search.nearest(indexed, asked)


@query("op4_secret_forest")
def op4_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.findings(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_license_sentences")
def op10_license_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.recognised(table(spark, folder, "documents"))


@query("op11_importance_resampling")
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _rounds_sql(rounds: int = centroids.ROUNDS, k: int = centroids.K) -> str:
    """Clustering of ``embeddings`` with a common table expression per step of a round."""
    steps = f"""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = {centroids.DIM}
    AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIM}),
v AS MATERIALIZED (
  SELECT r, vec_id, unnest(range({centroids.DIM})) AS d,
         unnest(list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT))) AS x FROM kept),
seeds AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || CAST(vec_id AS VARCHAR))) - 1 AS c
  FROM kept QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, d, x FROM seeds JOIN v USING (r))"""
    nearest = """
g{i} AS (
  SELECT r, c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS gap FROM v JOIN c{i} m USING (d) GROUP BY r, c),
a{i} AS MATERIALIZED (
  SELECT r, c, gap FROM g{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY gap, c) = 1)"""
    moved = """
s{i} AS (
  SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY c, d),
c{j} AS MATERIALIZED (
  SELECT m.c, m.d, CASE WHEN s IS NULL THEN m.x ELSE (s - (s % n + n) % n) // n END AS x
  FROM c{i} m LEFT JOIN s{i} USING (c, d))"""
    for i in range(rounds):
        steps += "," + nearest.format(i=i) + "," + moved.format(i=i, j=i + 1)
    steps += "," + nearest.format(i=rounds)
    return f"""WITH {steps},
digests AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, gap AS distance,
       CAST(sum(gap) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(gap) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN digests USING (c)"""


@query("op12_centroid_clusters", _rounds_sql())
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.clustered(table(spark, folder, "embeddings"))
    digest = centroids.centroid_digest(F.col("centroid")).alias("centroid_sha256")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest)


@query("op13_word_bpe")
def op13_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = word_bpe.default_path()
    done = word_bpe.decoded(word_bpe.encoded(table(spark, folder, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )
