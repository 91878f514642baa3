"""Global order: running totals and row numbers over any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.session import cut, parallelism
from placeseek.sizing import join_checked


def with_running_total(
    df: DataFrame, keys: Sequence[str], weight: Column, out: str
) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to this one in ``keys`` order.

    ``keys`` must be unique, so that ranges of them split evenly. The data is cut into
    ranges once and stored, because range borders may differ if they are computed
    again. Sums inside a range run in parallel; only one number per range meets in a
    single task.
    """
    keys = list(keys)
    ranges = parallelism(df.sparkSession)
    ranged = cut(
        df.withColumn("_w", weight.cast("long"))
        .repartitionByRange(ranges, *keys)
        .withColumn("_range", F.spark_partition_id())
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("_w").alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # At most ``ranges`` rows, whatever the data size.
    return (
        ranged.withColumn("_inside", F.sum("_w").over(inside))
        .join(F.broadcast(offsets), "_range")
        .select(*df.columns, (F.col("_before") + F.col("_inside")).alias(out))
    )


def with_part_number(df: DataFrame, key: str, size: int = 300, out: str = "part") -> DataFrame:
    """Number rows in key order and deal them into parts of ``size`` rows, from 1."""
    placed = with_running_total(df.select(key), [key], F.lit(1), "_position")
    part = F.floor((F.col("_position") - 1) / size).cast("long") + 1
    # Only keys are put in order; the rows meet their number by a join.
    return join_checked(df, placed.select(key, part.alias(out)), key).select(*df.columns, out)
