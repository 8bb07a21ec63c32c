"""Connected components of a table of links, by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    Large-star and small-star steps by turns: every node's links move to its
    smallest neighbour until nothing changes. Both are an aggregate and a join
    on the node, never a gathered neighbourhood, so a node with very many
    links is split like any other skewed join key. Each step is written to
    the shared folder."""
    edges = written(_oriented(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    signature = _signature(edges)
    while signature[0]:
        # Large star: neighbours above a node move to its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _oriented(both.filter("v > u").join(least, "u").select("v", F.col("m").alias("u")))
        # Small star: neighbours below a node, and itself, move to the smallest.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select("u", "v", "m")
        after = written(_oriented(small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(
            small.select("v", F.col("m").alias("u")))), "links")
        edges, before, signature = after, signature, _signature(after)
        if signature == before:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    """Number of links and two sums of their hashes: equal for equal sets."""
    codes = [F.sum(F.xxhash64("u", "v", F.lit(k)).cast("decimal(38,0)")) for k in (0, 1)]
    return tuple(edges.agg(F.count("*"), *codes).first())


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct links from the smaller node (u) to the larger (v)."""
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct()
