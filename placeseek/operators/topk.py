"""Best k rows per group without sending a whole group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this bound Spark no longer limits groups before the shuffle.
GROUP_LIMIT = 1000
SALTS = 64


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    unique: str,
    rank: str = "rank",
) -> DataFrame:
    """Rows ranked 1..k per group. ``unique`` tells rows of one group apart.

    ``row_number() <= k`` sits directly on the window, so Spark keeps at most k rows
    per group in each task before it shuffles. For a k too large for that, a first
    round over salted groups does the same job.
    """
    if k > GROUP_LIMIT:
        salted = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(unique), F.lit(SALTS)))
            .withColumn("_rank", F.row_number().over(salted))
            .filter(F.col("_rank") <= k)
            .drop("_salt", "_rank")
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
