"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``, ``root`` for every node with a link; the root is the smallest node.

    ``links`` has columns ``a`` and ``b``.  Large-star and small-star steps alternate
    until nothing changes; the number of rounds grows with the logarithm of the
    longest path.  Every step is a grouped minimum, combined before the shuffle, and
    a join with one row per node, in which adaptive execution splits a node with many links.
    ``scratch`` can drop the result.
    """
    edges = scratch.keep(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while not _is_forest(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least.select("u", F.least("u", "m").alias("m")), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        wide = scratch.keep(large)
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        moved = wide.join(least, "u").where(F.col("v") != F.col("m"))
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        following = scratch.keep(small.distinct())
        scratch.drop(edges, wide)
        edges = following
    return scratch.view(edges, edges.select(F.col("u").alias("node"), F.col("v").alias("root")))


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root that has none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("x")).union(
        edges.select(F.col("v"), F.lit(0)).distinct()
    )
    seen = ends.groupBy("n").agg(F.sum("x").alias("out"), F.count("*").alias("all"))
    return seen.where("out > 1 or (out = 1 and all > 1)").isEmpty()
