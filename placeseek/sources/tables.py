"""The post table and the tables it is fed from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions import values as vx
from placeseek.schema import POST
from placeseek.session import parallelism

POST_COLUMNS = tuple(POST.names)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a stored post table."""
    return spark.read.schema(POST).parquet(path).select(*POST_COLUMNS)


def write_posts(posts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store posts in ranges of id, so that a lookup of a few ids skips most of the file."""
    (
        posts.select(*POST_COLUMNS)
        .repartitionByRange(parallelism(posts.sparkSession), "id")
        .sortWithinPartitions("id")
        .write.mode(mode)
        .parquet(path)
    )


def read_posts_jdbc(
    spark: SparkSession, url: str, table: str, lowest: int, highest: int, partitions: int, **options: str
) -> DataFrame:
    """Scan of a relational post table in parallel ranges of id."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", "id")
        .option("lowerBound", lowest)
        .option("upperBound", highest)
        .option("numPartitions", partitions)
        .load()
        .select(*POST_COLUMNS)
    )


def duplicate_keys(posts: DataFrame, key: str = "page_url") -> DataFrame:
    """Keys that break uniqueness, with their number of rows, and null keys."""
    return (
        posts.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())
    )


# -- feeding posts from the given tables ------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_small: dict[tuple, bool] = {}


def dealt_out(df: DataFrame, key: str, below: int = 256 * 1024 * 1024) -> DataFrame:
    """Spread a small input over all cores by ``key``; larger ones are left as scanned.

    A scan cannot split a row group, so a small file may end up in one task, whatever
    the work per row. Large inputs have row groups enough and are not shuffled.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    seen = (spark.sparkContext.applicationId, *files[:64])
    if seen not in _small:
        few = 0 < len(files) <= 64
        sizes = spark.read.format("binaryFile").load(files) if few else None
        _small[seen] = few and sizes.agg(F.sum("length")).first()[0] < below
    cores = max(1, spark.sparkContext.defaultParallelism)
    return df.repartition(min(cores, parallelism(spark)), key) if _small[seen] else df


def _line(text: Column, number: int) -> Column:
    """The numbered line of a text, or an empty string."""
    return F.split_part(text, F.lit("\n"), F.lit(number))


def posts_from_documents(
    spark: SparkSession, folder: str, columns: Iterable[str] = POST_COLUMNS, busy: bool = False
) -> DataFrame:
    """Posts made of the document table; joins only what the asked columns need.

    ``busy`` announces heavy work per row. Title and description are the first two lines. Places come from the nation and
    region tables, authors exist where a label does.
    """
    wanted = list(columns)
    docs = table(spark, folder, "documents")
    if busy:
        docs = dealt_out(docs, "doc_id")
    built = {
        "id": F.col("doc_id").cast("long"),
        "blog_url": F.col("source"),
        "page_url": F.concat(
            F.lit("https://"), F.col("source"), F.lit(".example.com/"),
            (F.col("doc_id") % 900).cast("string"), F.lit("/"),
        ),
        "page_title": _line(F.col("text"), 1),
        "page_description": _line(F.col("text"), 2),
        "content": F.col("text"),
    }
    if "page_author" in wanted:
        labelled = table(spark, folder, "labels").select("doc_id", F.lit(True).alias("_labelled"))
        docs = docs.join(labelled, "doc_id", "left")
        built["page_author"] = F.when(
            F.col("_labelled"), F.concat(F.lit("author_"), (F.col("doc_id") % 97).cast("string"))
        )
    if {"location_name", "latitude", "longitude"} & set(wanted):
        docs = docs.withColumn("n_nationkey", (F.col("doc_id") % 25).cast("int"))
        docs = docs.join(place_table(spark, folder), "n_nationkey", "left")
        built["location_name"] = F.when(
            F.col("doc_id") % 7 == 0, F.col("n_name")
        ).otherwise(F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")))
        built["latitude"], built["longitude"] = F.col("lat"), F.col("lon")
    return docs.select(*[built[c].alias(c) for c in wanted])


def place_table(spark: SparkSession, folder: str) -> DataFrame:
    """(n_nationkey, n_name, r_name, lat, lon): one row per nation."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    key = F.col("n_nationkey")
    known = key % 11 != 10
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        "n_name",
        "r_name",
        F.when(known, (key * 37 % 181 - 90).cast("double")).alias("lat"),
        F.when(known, (key * 91 % 361 - 180).cast("double")).alias("lon"),
    )


def normalised(posts: DataFrame) -> DataFrame:
    """Posts with NaN coordinates as nulls and columns in their stored types."""
    return posts.select(
        *[
            (vx.without_nan(F.col(f.name).cast("double")) if f.dataType.typeName() == "double" else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in POST.fields
        ]
    )
