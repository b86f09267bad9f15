"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def components(links: DataFrame, under: str | None = None) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (columns a, b: long).

    Alternates two steps until only stars are left: every node hands the smallest
    node it sees to its larger neighbours, then to its smaller ones. Minima are
    folded before they are shuffled and no node's neighbours are collected, so a
    node may have any number of links. Each step is written (in the folder ``under``), so that no plan grows.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", under)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        wide = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        wide = saved(wide.distinct(), "links", under)
        low = wide.groupBy("a").agg(F.min("b").alias("low"))
        near = wide.join(low, "a").select(F.greatest("b", "low").alias("a"), F.col("low").alias("b"))
        near = near.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b")
        edges = saved(near.distinct(), "links", under)
        # a star: every larger node has one link, and no smaller node is a larger one too
        ends = edges.select("a", F.lit(1).alias("n")).unionByName(edges.select(F.col("b").alias("a"), F.lit(1).alias("n")).distinct())
        if ends.groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").isEmpty():
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
