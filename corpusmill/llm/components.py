"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.staging import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _rounds(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = stage(large.where("u > v").distinct(), "large-star-links")
    lowest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
    moved = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lowest.select("u", F.col("m").alias("v"))
    return stage(own.unionByName(moved).distinct(), "small-star-links")


def components(links: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Every step is written to a stage table: a lost executor repeats one step. The minima are combined
    before they are shuffled, and joined as tables of their own, so that a hub's links can be split.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = stage(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        edges = _rounds(edges)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
