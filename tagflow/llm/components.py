"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagflow.llm.common import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) of every node that has an edge to another.

    Large star: every larger neighbour of a node is linked to the node's smallest
    neighbour. Small star: every smaller-or-equal one is. Both only use a minimum per
    node and joins on nodes, so a large component is never gathered. The steps end when
    they change nothing; their number grows with the logarithm of the longest path.
    """
    now = cut(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    )
    count = None
    while True:
        both = _both(now)
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (
            both.join(low, both["a"] == low["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        small_low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        joined = large.join(small_low, large["a"] == small_low["n"])
        small = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = cut(small.where("a <> b").distinct())
        key = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if key == count:
            break
        now, count = after, key
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
