"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest of the node's neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """u, v (any order, repeats allowed) -> node, component: the smallest node it is tied to.

    Nodes without an edge, and edges of a node to itself or to null, do not appear. No edges
    give no rows. Each round is two grouped minima with joins, stored in the shared folder;
    the rounds grow with the logarithm of the graph's diameter. The neighbours of one node
    are never gathered: minima combine on the map side, and Spark splits a hot join key.
    """
    current = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), purpose
    )
    seen = _signature(current)
    while seen[0]:
        following = stored(_small_star(_large_star(current)), purpose)
        now = _signature(following)
        current = following
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
