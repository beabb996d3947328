"""Connected components of any number of links, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to its smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """Per node of the links (columns `a`, `b`), `component`: the smallest node that it reaches.

    Alternating large-star and small-star steps, each written, until every node hangs on the
    smallest one of its component. A node with many links is one key of a join against one row
    per node, which Spark's skew handling can split; nothing is gathered per node.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        # Stars: no node stands on both sides, and no node has two centres.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = state
        if not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = materialize(_small_star(_large_star(edges)).where("a <> b").distinct())
