"""Stored text vectors. Paths may point to any file system Spark can read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.schema import VECTOR
from placeseek.session import parallelism
from placeseek.sizing import exists, join_checked

KEYED = "digest string, embedding array<float>"


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """One row per post: (id, embedding)."""
    return spark.read.schema(VECTOR).parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    vectors.select(
        F.col("id").cast("long"), F.col("embedding").cast("array<float>").alias("embedding")
    ).write.mode("overwrite").parquet(path)


def upsert_vectors(
    posts: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame], text: str = "text"
) -> DataFrame:
    """(id, embedding) of ``posts(id, text)``; only texts the store has not seen are encoded.

    The store under ``path`` is keyed by the digest of a text, so copies and unchanged posts cost a look-up, and a
    changed post one encoding. ``encode`` adds ``embedding`` to rows (digest, text); they come ordered by
    length, so that the batches of a model hold texts of like size. Null texts are empty ones.
    """
    spark = posts.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = posts.select("id", F.sha2(whole, 256).alias("digest"))
    new = keyed
    if exists(spark, path):
        seen = spark.read.schema(KEYED).parquet(path).select("digest")
        new = keyed.join(seen, "digest", "left_anti")
    new = new.groupBy("digest").agg(F.min("id").alias("id"))
    texts = join_checked(posts.select("id", whole.alias("text")), new, "id").select("digest", "text")
    dealt = texts.withColumn("_size", F.char_length("text")).repartitionByRange(parallelism(spark), "_size", "digest")
    encoded = encode(dealt.sortWithinPartitions("_size").select("digest", "text"))
    encoded.select("digest", F.col("embedding").cast("array<float>").alias("embedding")).write.mode("append").parquet(path)
    known = spark.read.schema(KEYED).parquet(path)
    return join_checked(keyed, known, "digest", spread="id").select("id", "embedding")


def unpack_blocks(blocks: DataFrame) -> DataFrame:
    """Rows (id, embedding) from blocks that hold a list of ids and a parallel matrix."""
    pairs = F.arrays_zip("ids", "embeddings")
    return blocks.select(F.explode(pairs).alias("e")).select(
        F.col("e.ids").cast("long").alias("id"), F.col("e.embeddings").alias("embedding")
    )


def pack_blocks(vectors: DataFrame, rows: int = 64) -> DataFrame:
    """Blocks of at most ``rows`` neighbouring ids: (block, ids, embeddings)."""
    ordered = F.array_sort(F.collect_list(F.struct("id", "embedding")))
    packed = vectors.groupBy(F.floor(F.col("id") / rows).alias("block")).agg(ordered.alias("e"))
    return packed.select(
        "block",
        F.transform("e", lambda x: x["id"]).alias("ids"),
        F.transform("e", lambda x: x["embedding"]).alias("embeddings"),
    )
