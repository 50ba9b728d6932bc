"""Connected components of a list of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b; both bigint); component is the least node reachable.

    A round hangs the larger neighbours of each node on its least neighbour, then the smaller ones, so paths shrink to
    stars in a number of rounds that grows with the logarithm of their length, and stars are the end. Minima are summed up before they
    shuffle and checkpointed; the join with them can be split where a node has very many neighbours."""
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = checkpointed(large)
        least = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        hung = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        if _are_stars(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that others hang on hangs itself."""
    heads = edges.select(F.col("b").alias("a")).distinct().withColumn("head", F.lit(True))
    hung = edges.groupBy("a").agg(F.count("*").alias("n"))
    return not hung.join(heads, "a", "left").filter("n > 1 OR head").limit(1).count()
