"""Text, CSV and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.operators.positions import with_part_number
from placeseek.schema import POST, RANKED_EXPORT

PART_ROWS = 300
# How a missing value is written, as opposed to an empty text.
MISSING = "\\N"


def read_csv(spark: SparkSession, path: str, schema=POST) -> DataFrame:
    """CSV with a header, quoted fields over several lines and fields of any length."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxCharsPerColumn", -1)
        .option("encoding", "UTF-8")
        .option("nullValue", MISSING)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, folders: Sequence[str] = ()) -> None:
    """Quotes doubled, blanks kept, missing values marked; ``folders`` become folder names."""
    (
        df.write.mode("overwrite").partitionBy(*folders)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .option("nullValue", MISSING)
        .csv(path)
    )


def write_seeds(urls: DataFrame, path: str) -> None:
    """One URL per line."""
    urls.select("url").write.mode("overwrite").text(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("url")).filter(F.col("url") != "")


def read_query_set(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query) from a JSON object that holds an array named ``queries``."""
    raw = spark.read.schema("queries array<string>").option("multiLine", True).json(path)
    return raw.select(F.posexplode("queries").alias("query_id", "query")).select(
        F.col("query_id").cast("long"), "query"
    )


def write_json_parts(posts: DataFrame, path: str, size: int = PART_ROWS, key: str = "id") -> None:
    """JSON lines in folders ``part=1, 2, ...`` of exactly ``size`` rows in key order."""
    with_part_number(posts, key, size).write.mode("overwrite").partitionBy("part").json(path)


def write_json(posts: DataFrame, path: str) -> None:
    """The whole collection as JSON lines; characters stay as they are."""
    posts.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def ranked_export(hits: DataFrame) -> DataFrame:
    """Hits under the names of the ranked export, with their query; best first within each."""
    dealt = hits.repartition("query_id").sortWithinPartitions("query_id", F.desc("score"), F.asc("id"))
    return dealt.select(
        "query_id",
        F.col("score").cast("double").alias("Score"),
        F.col("location_name").alias("Location Name"),
        F.col("page_title").alias("Page Title"),
        F.col("longitude").cast("double").alias("Longitude"),
        F.col("latitude").cast("double").alias("Latitude"),
    )


def write_ranked(hits: DataFrame, path: str) -> None:
    """The k best rows of each query as one CSV file in a folder of its own."""
    write_csv(ranked_export(hits), path, ["query_id"])


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, f"{RANKED_EXPORT.toDDL()}, query_id long")
