"""Append to the post table, one row per page address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.operators.topk import top_k
from placeseek.schema import POST
from placeseek.sizing import exists, localised, one_of
from placeseek.sources.tables import POST_COLUMNS, duplicate_keys

KEY = "page_url"
# Buckets of a new table, and the bits of the bitmap that Spark's bitmap functions build.
BUCKETS = 16
FILTER_BITS = 32_768
STORED = T.StructType([*POST.fields, T.StructField("bucket", T.IntegerType())])
FILTERS = "bucket int, bits binary, buckets int"


def create_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the post table if it does not exist."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in POST.fields
    )
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def check_key(posts: DataFrame) -> None:
    """Fail when a page address is missing or occurs twice."""
    wrong = duplicate_keys(posts, KEY).limit(5).collect()
    if wrong:
        raise ValueError(f"page_url not unique or null: {[r[0] for r in wrong]}")


def first_per_key(arrivals: DataFrame, order: str = "id") -> DataFrame:
    """The first row of each page address in order of arrival; rows without one drop.

    At most one row per address leaves each task, so a much repeated one is no burden.
    """
    keyed = arrivals.filter(F.col(KEY).isNotNull())
    return top_k(keyed, [KEY], [F.asc(order)], 1, order, rank="_place").drop("_place")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int").alias("bucket")


def _part() -> Column:
    """Deals a bucket over a few tasks, so that a large one is no single task."""
    return F.pmod(F.xxhash64(F.lit(3), KEY), F.lit(4))


def _bits() -> list[Column]:
    """Places of an address in the bitmap of its bucket: two, from independent hashes."""
    return [F.pmod(F.xxhash64(F.lit(seed), KEY), F.lit(FILTER_BITS)).cast("int") for seed in (1, 2)]


def existing_posts(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored posts with their ``bucket``; None before the first append."""
    if not exists(spark, path):
        return None
    return spark.read.schema(STORED).parquet(path)


def _filters(spark: SparkSession, path: str) -> DataFrame | None:
    at = f"{path}/_filters"
    return spark.read.schema(FILTERS).parquet(at) if exists(spark, at) else None


def _possibly_stored(keyed: DataFrame, filters: DataFrame) -> DataFrame:
    """Rows (page_url, bucket, bits) all of whose bits are set in the filter of their bucket."""
    merged = filters.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("_set"))
    held = keyed.join(merged, "bucket")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_set"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.expr("1").cast("int") * F.pow(F.lit(2), bit % 8).cast("int")) != 0

    return held.filter(is_set(F.col("bits")[0]) & is_set(F.col("bits")[1])).select(KEY, "bucket")


def taken(fresh: DataFrame, path: str, buckets: int) -> DataFrame | None:
    """(page_url) of the fresh rows that the table holds already.

    Bitmaps tell most new addresses apart without a look at the table. For the others only the buckets
    that may hold them are read, and of these only the address column.
    """
    spark = fresh.sparkSession
    existing, filters = existing_posts(spark, path), _filters(spark, path)
    if existing is None or filters is None:
        return None
    keyed = fresh.select(KEY, _bucket(buckets), F.array(*_bits()).alias("bits"))
    keys, rows = localised(_possibly_stored(keyed, filters))
    if rows is not None:
        hit = sorted({r["bucket"] for r in rows})
    else:
        hit = sorted(r.bucket for r in keys.select("bucket").distinct().collect())  # no more than buckets
    stored_keys = existing.filter(one_of("bucket", hit)).select(KEY, "bucket")
    return stored_keys.join(F.broadcast(keys) if rows is not None else keys, [KEY, "bucket"], "left_semi").select(KEY)


def append_new(arrivals: DataFrame, path: str, order: str = "id", buckets: int = BUCKETS) -> None:
    """Append the first row of each address that the table does not hold; stored rows are never touched.

    Posts lie in buckets by a hash of their address, and every append adds its addresses to the buckets'
    bitmaps before it adds the posts: if it fails in between, the bitmaps only say "perhaps" more
    often, and a repeated append adds what is missing and nothing twice. ``buckets`` counts for the first
    append; later ones keep to it.
    """
    spark = arrivals.sparkSession
    filters = _filters(spark, path)
    if filters is not None:
        buckets = filters.agg(F.max("buckets")).first()[0]
    # A batch is small beside the table; it is worked out once.
    fresh = first_per_key(arrivals, order).persist()
    try:
        known = taken(fresh, path, buckets)
        added = fresh if known is None else fresh.join(known, KEY, "left_anti")
        added = added.select(*POST_COLUMNS, _bucket(buckets))
        bits = added.select("bucket", F.explode(F.array(*_bits())).alias("_bit"))
        bitmaps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        # A row per bucket.
        bitmaps.withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("append").parquet(f"{path}/_filters")
        added.repartition("bucket", _part()).write.mode("append").partitionBy("bucket").parquet(path)
    finally:
        fresh.unpersist()
