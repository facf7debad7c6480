"""Smallest connected node of each node, from a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import keep

#: Few links are handled by few tasks, whatever the number of shuffle partitions.
LINKS_PER_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the least node of its component.

    Links are turned, round by round, into stars around the least nodes: first each node hands its
    larger neighbours to the least of all its neighbours, then its smaller ones. Links are only
    joined with one row per node, and what a node gathers is a minimum, so a node with many links
    stays spread. The rounds end when a round changes nothing. Self links are allowed.
    """
    edges, before = keep(links.select("a", "b").distinct()), None
    while (now := edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) != before:
        before, tasks = now, 1 + now[0] // LINKS_PER_TASK
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = _star(both, large=True).coalesce(tasks)
        edges = keep(_star(larger, large=False).distinct().coalesce(tasks))
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).filter("node != root")
    heads = edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(heads).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links (least, node) that keep the components; ``a`` is the node whose neighbours move."""
    if not large:  # turned so that each link is held by its larger end
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    moved = edges.filter(F.col("b") >= F.col("a")) if large else edges
    handed = moved.join(least, "a").select(F.col("least").alias("a"), "b")
    own = least.select(F.col("least").alias("a"), F.col("a").alias("b"))
    return handed.unionByName(own).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
