"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens.sources.folders import RunFolder


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame, run: RunFolder, name: str) -> DataFrame:
    """node, component (its smallest node) of all nodes of the edges (a, b). Both sides of a round
    are grouped and joined by node, so Spark can split the edges of a node with many."""
    edges = run.keep(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(),
        f"{name}_0",
    )
    seen, turn = _state(edges), 0
    while seen[0]:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = run.keep(large.where("a > b").distinct(), f"{name}_{turn}_large")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        turn += 1
        edges = run.keep(
            moved.union(least.select("a", F.col("m").alias("b"))).where("a > b").distinct(), f"{name}_{turn}"
        )
        state = _state(edges)
        if state == seen:
            break
        seen = state
    # Every edge now leads straight to the smallest node.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
