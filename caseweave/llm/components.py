"""Connected components of a graph given by its edges, by alternating star steps.

Each step links neighbours to the smallest node known to them, so that after
about log(n) ** 2 steps every node hangs on the smallest one of its component.
Edges are written to the shared folder after each round; only two numbers per
round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.sinks.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """From (a, b) pairs to (node, root): nodes that are not the smallest of their component."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(pairs.distinct(), "component-edges")
    seen = None
    while True:
        found = _state(current)
        if found == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = found
        current = stage(_small_star(_large_star(current)), "component-edges")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
