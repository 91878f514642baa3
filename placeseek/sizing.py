"""Joins that broadcast a side only after its size was checked.

Sides that come straight from files need none of this: the optimizer knows their size
and broadcasts them on its own when they are small. The helpers below are for sides
whose size the optimizer cannot know before it runs, such as exploded query terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 64 * 1024 * 1024
SALTS = 32
# Rows of one key that a single task handles without trouble.
HOT_ROWS = 1_000_000


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble with the store is an error."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_chars`` bytes in all columns.

    Reads no more than ``max_rows + 1`` rows.
    """
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(F.col(field.name)).cast("long"), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            # Nested values count by their text, which is never shorter than a few bytes each.
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))).cast("long"), F.lit(0))
        else:
            size = size + F.lit(8)
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return row[0] <= max_rows and (row[1] or 0) <= max_chars


def localised(df: DataFrame, max_rows: int = 20_000) -> tuple[DataFrame, list | None]:
    """``df`` as a local table together with its rows when it has at most ``max_rows``.

    Otherwise ``df`` itself and None. Small request tables are thus computed once, and
    the optimizer knows their size.
    """
    arrow = df.limit(max_rows + 1).toArrow()
    if arrow.num_rows > max_rows:
        return df, None
    return df.sparkSession.createDataFrame(arrow, df.schema), arrow.to_pylist()


def one_of(column: str, values: Sequence[int] | Sequence[str]) -> Column:
    """``column IN (values)`` for numbers or words, built in one step however many."""
    if any(isinstance(v, str) and ("'" in v or "\\" in v) for v in values):
        return F.col(column).isin(list(values))
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return F.expr(f"`{column}` IN ({listed})") if values else F.lit(False)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys with more rows than one task should get; at most (rows of df) / ``rows`` of them."""
    bound = HOT_ROWS if rows is None else rows
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") > bound).select(*keys)


def join_checked(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: str | Sequence[str] | None = None,
    small_fits: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``large`` with ``small``, broadcasting ``small`` when it fits.

    Beyond the bound both sides are shuffled. ``spread`` names columns of ``large``
    that vary inside a key: rows of a hot key are dealt over ``SALTS`` partitions by
    them, and ``small`` is repeated once per salt for those keys only. ``hot`` lists the
    hot keys where the caller knows them; otherwise they are counted first. Each row of
    ``large`` carries exactly one salt, so inner, left, semi and anti joins keep their
    results. Rows without a key are dealt out too, as they match nothing.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small_fits is None:
        small_fits = fits(small)
    if small_fits:
        return large.join(F.broadcast(small), keys, how)
    if spread is None:
        return large.join(small, keys, how)
    columns = [spread] if isinstance(spread, str) else list(spread)
    listed, rows = localised(hot if hot is not None else hot_keys(large, keys))
    marked = listed.withColumn("_hot", F.lit(True))
    if rows is not None or fits(listed):
        marked = F.broadcast(marked)
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    dealt = F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")
    salted = large.join(marked, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | keyless, dealt).otherwise(0)
    )
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = small.join(marked, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    return salted.drop("_hot").join(copies.drop("_hot"), keys + ["_salt"], how).drop("_salt")
