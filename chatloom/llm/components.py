"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chatloom.plans.staging import stage


def _staged(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Write the edges once; their number and a sum over them tell whether a round changed any."""
    seen = Observation()
    watched = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("check"),
    )
    out = stage(watched, "edges")
    return out, (seen.get["n"], seen.get["check"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stage(both.groupBy("u").agg(F.min("v").alias("m")), "low")
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the smallest of them (here u > v)."""
    low = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "low")
    kept = low.select("u", F.col("m").alias("v"))
    moved = (
        edges.join(low, "u")
        .where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return kept.unionByName(moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type; order, repeats and
    loops do not matter, edges with a null are ignored. Rounds follow the logarithm of
    the longest path. Each round is two joins against a written table of one row per node, so
    a node with very many neighbours is a skewed join that adaptive execution splits, and
    each round's edges go to the shared folder. No component is gathered anywhere.
    """
    pairs = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    current, mark = _staged(pairs)
    while mark[0]:
        current, now = _staged(_small_star(stage(_large_star(current), "large")))
        if now == mark:
            break
        mark = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
