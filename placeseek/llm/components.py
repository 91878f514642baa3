"""Connected components of a graph given as edges; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.session import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node of (a, b) edges.

    Alternates large-star and small-star steps, which keep the components and end in one
    star per component after a number of rounds that grows with the logarithm of the
    longest path. Every step is a grouped minimum and a join, written to the shared folder.
    Null ends and loops are no edges; no edge, no row.
    """
    both = edges.filter("a is not null and b is not null and a <> b")
    current = stored(
        both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    for _ in range(rounds):
        # Large star: larger neighbours go to the smallest neighbour.
        ends = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            ends.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stored(large.filter("u <> v"), "large")
        # Small star: smaller neighbours and the node itself go to the smallest neighbour.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(smallest, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select("u", F.col("m").alias("v"))
        )
        current = stored(small.filter("u <> v").distinct(), "small")
        row = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        if tuple(row) == before:
            break
        before = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
