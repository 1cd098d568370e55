"""Connected components by alternating large and small stars, without collecting a neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import stage


def _settled(edges: DataFrame) -> bool:
    """Every node is either linked to one smaller node or only linked to: the links are finished stars."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    per_node = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return not per_node.agg(F.max((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0)))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of longs → (node, label) for every linked node, label the smallest node reachable.

    The links are staged after every round, so a lost executor repeats one
    round.  A link of a node with itself, and repeated links, change nothing.
    """
    edges = stage(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(edges):
        edges = stage(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
