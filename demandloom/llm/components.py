"""Connected components of links between documents, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``: the smallest node it is connected with.

    Large-star and small-star steps turn the links into stars around the smallest nodes; the number of
    rounds follows the logarithm of the longest chain. Each round is written to the shared folder. Links
    of a node with itself and repeated links change nothing.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    before = _checksum(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = stage(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, "small-star")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("a"), "b")
    return edges.unionByName(roots).distinct().select(F.col("a").alias("node"), F.col("b").alias("label"))
