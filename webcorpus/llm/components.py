"""Connected components of a stored link table, by alternating star rewiring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.session import written


def _smallest(edges: DataFrame, name: str) -> DataFrame:
    """(a, low): the smallest neighbour of each a; written, so that a skewed join can be split."""
    return written(edges.groupBy("a").agg(F.min("b").alias("low")), name)


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of links (a, b), the smallest node it is connected with.

    Each round hangs the larger neighbours of a node below the smallest one, then the smaller ones;
    the rounds grow with the logarithm of the nodes. No group is gathered: a round is two
    aggregations by minimum and two joins, and its links are written, which cuts the lineage.
    """
    edges = written(links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both, "low").withColumn("low", F.least("a", "low"))
        large = written(both.join(low, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large")
        low = _smallest(large, "low")
        small = large.join(low, "a").filter("b != low").select(
            F.col("b").alias("a"), F.col("low").alias("b"))
        edges = written(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct())
        before = now
