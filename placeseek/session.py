"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "placeseek") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder would be lost with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="placeseek-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared folder."""
    return f"{shared_dir(spark)}/placeseek/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and continue from the written rows.

    Use where later steps must see exactly the same rows in the same partitions, or
    where several branches would repeat an expensive step.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut`, but as a parquet table, so that later reads prune columns."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Number of partitions asked for where the code must name one.

    A local session has no use for more than its cores; elsewhere the session's own
    setting is meant for the data at hand.
    """
    wanted = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    if spark.sparkContext.master.startswith("local"):
        return min(wanted, max(1, spark.sparkContext.defaultParallelism))
    return wanted
