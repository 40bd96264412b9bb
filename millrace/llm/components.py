"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise


def connected(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it is linked to over any number of links.

    `links` has two bigint columns, `a` and `b`. Nodes without links do not appear. Each round points every node at the
    smallest neighbour, first from above and then from below, until the links are stars around the roots; the number of
    rounds grows with the logarithm of the longest chain. Minima are aggregated before they are shuffled, and each round
    is written to the scratch folder, so a lost executor costs one round at most. The driver sees two numbers a round.
    """
    edges = materialise(
        links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links"
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).head()
        if tuple(state) == before:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                edges.select(F.col("low"), F.col("low")).distinct()
            )
        before = tuple(state)
        edges = materialise(_small_star(_large_star(edges)), "links")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.select(F.col("low").alias("n"), F.col("high").alias("m")).union(edges.select("high", "low"))
    least = both.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("least"))
    return both.filter("m > n").join(least, "n").select(F.col("least").alias("low"), F.col("m").alias("high")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of these neighbours."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").select(F.col("least").alias("low"), F.col("low").alias("high"))
    kept = least.select(F.col("least").alias("low"), F.col("high"))
    return moved.union(kept).filter("low < high").distinct()
