"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours at its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points itself and its smaller neighbours at the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node points at one other, which points nowhere."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or out = 1 and into = 1").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (u long, v long); component is the least node.

    Rows are (u, v) with u > v after the first step, so at the end each edge is a node and its
    component.  The number of rounds grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "edges")
    while not _settled(edges):
        spent, edges = edges, stored(_small_star(_large_star(edges)), "edges")
        discard(spent)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
