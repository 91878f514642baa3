"""Row types of the stored tables."""

from pyspark.sql import types as T

POST = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("blog_url", T.StringType()),
        T.StructField("page_url", T.StringType(), False),
        T.StructField("page_title", T.StringType()),
        T.StructField("page_description", T.StringType()),
        T.StructField("page_author", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("content", T.StringType()),
    ]
)

SCRAPED = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("url", "title", "description", "author", "content", "base_domain")
    ]
)

VECTOR = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

QUERY = T.StructType(
    [
        T.StructField("query_id", T.LongType(), False),
        T.StructField("query", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("k", T.IntegerType()),
    ]
)

RANKED_EXPORT = T.StructType(
    [
        T.StructField("Score", T.DoubleType()),
        T.StructField("Location Name", T.StringType()),
        T.StructField("Page Title", T.StringType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Latitude", T.DoubleType()),
    ]
)
