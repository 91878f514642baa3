"""A training-data pipeline: every stage works on what its predecessor kept.

Toxic documents go, recurring lines are dropped, one document of each group of near copies
stays (the one with the smallest doc_id), documents that hold benchmark items go, and what is
left is packed into sequences. All stages but the last return the columns of documents, extra ones
included. An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.llm import decontamination, line_templates, ngram_join, packing, tokens, toxicity
from placeseek.llm.registry import table
from placeseek.session import work_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers reject go; null and empty texts have no words to be rejected by."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from the texts; null texts and rows without doc_id stay as they are."""
    # Columns of the operator's own names are set aside.
    aside = {c: f"__{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    kept = line_templates.deduplicated(docs.withColumnsRenamed(aside))
    kept = kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id.

    Documents without words are in no group and stay; rows without doc_id name no document and go.
    """
    kept = ngram_join.linked(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("__kept"))
    return docs.join(kept.hint("shuffle_hash"), F.col("doc_id") == F.col("__kept"), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; without items or words nothing does."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document; a document without text is its end mark alone."""
    return packing.packed(docs, tokens.default_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Classifier chains and packing by local search cannot be expressed in SQL; the tests hold
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
