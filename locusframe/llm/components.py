"""Connected components of links by alternating star contractions, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from locusframe.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): component is its smallest node.

    A round points the larger neighbours of each node at its smallest one, then the smaller ones. Both keep
    components whole; when nothing moves every node points at the smallest of its component. Smallest
    neighbours come from partial aggregates, and joins are between written tables, so a node with very many
    links is a skewed join that Spark can split.
    """
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    signature = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = materialize(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
            "a <> b").distinct(), "large-star")
        down = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        edges = materialize(large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            down.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == signature:
            break
        signature = now
    smallest = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return smallest.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
