"""Connected components of a graph given as edges, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of the component. `edges`: columns a, b.

    Steps read tables written to the shared folder, so lineage stays short and a star's hot centre can be split by Spark's skew join.
    The number of steps grows with the logarithm of the longest chain, at worst with its square; no number of steps is fixed.
    """
    pair = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = cut_lineage(edges.where("a <> b").select(pair.alias("e")).select("e.*").distinct(), "edges")
    while not _only_stars(current):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "large-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = cut_lineage(large.distinct(), "large-star")
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")), "small-least")
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        current = cut_lineage(small.distinct(), "small-star")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, and no such neighbour has one itself."""
    sides = edges.select(F.col("a").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("top")))
    per_node = sides.groupBy("n").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    return per_node.where("low > 1 or (low = 1 and top = 1)").isEmpty()
