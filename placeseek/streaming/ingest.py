"""Posts that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from placeseek.schema import POST
from placeseek.sources.store import append_new


def arriving_posts(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """Stream of post files that are dropped into a folder."""
    return (
        spark.readStream.schema(POST).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def ingest(arrivals: DataFrame, table: str, progress: str) -> StreamingQuery:
    """Append arriving posts, skipping addresses stored at any earlier time.

    Posts carry no event time that could bound the state of a streaming duplicate
    filter, so the table's own buckets and bitmaps are the state. A batch repeated
    after a failure finds its rows stored and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        append_new(batch, table)

    return (
        arrivals.writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
