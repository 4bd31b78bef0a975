"""Connected components of an edge table by alternating star contractions, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Joins the neighbours of each node to the least one: the greater neighbours, or the lesser ones and the node itself."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))  # both directions
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = near.join(least, F.col("a") == F.col("node"))
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its least node) of every node that has an edge in edges (a, b); ends when the edges are stars."""
    now = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        now = staged(_stars(_stars(now, True), False), "edges")
        new = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("the components haven't settled")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
