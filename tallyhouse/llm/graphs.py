"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import stage


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges`` (a, b).

    Alternating large and small stars: every node sends its larger neighbours, then its smaller
    ones, to the smallest it knows, until the graph is a forest of stars. Each round is a few
    aggregations and joins that Spark partitions by node; a hub's neighbours are split by the
    adaptive skew join, and the minimum of a hub is summed before the shuffle.
    """
    forest = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    while not _stars(forest):
        both = forest.unionByName(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        forest = stage(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
    roots = forest.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return forest.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(forest: DataFrame) -> bool:
    """Every node has one parent and no parent has a parent."""
    once = forest.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0
    return once and forest.join(forest.select(F.col("u").alias("x")), F.col("v") == F.col("x"), "left_semi").limit(1).count() == 0
