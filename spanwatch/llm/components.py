"""Connected components of an edge table by alternating stars.

Every round is a join and two aggregations on the node, so a hub costs its own
edges once; no component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = both.filter("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def connected(edges: DataFrame) -> DataFrame:
    """Node and the smallest node it is joined to, for every node of an edge.

    ``edges`` has the columns a and b of one orderable type; loops and repeats are
    allowed, nulls are ignored. Rounds go on until nothing changes; their number
    grows with the logarithm of the longest path.
    """
    now = stored(edges.select("a", "b").filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(now)
    while before[0]:
        after = stored(_small_star(_large_star(now)), "edges")
        discard(now)
        now, seen = after, before
        before = _state(now)
        if before == seen:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
