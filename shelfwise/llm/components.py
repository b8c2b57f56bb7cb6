"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rounds before the loop gives up; stars need about log2 of the longest chain.
MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, keep) -> DataFrame:
    """Link the neighbours that ``keep`` selects to the least node around ``a``."""
    least = links.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("_m", "a"))
    return (
        links.join(least, "a").where(keep).select(F.greatest("b", "_m").alias("a"), F.least("b", "_m").alias("b"))
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node.

    Both steps only use minima, which combine before a shuffle, and joins whose other side has one
    row for a node, so a node with very many links is no burden for one task.  Every round is
    written to the shared folder: a lost executor costs one round at most.  Loops (a = b) give no
    row unless other links name the node.
    """
    links = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        large = _star(_both(links), F.col("b") > F.col("a")).where(F.col("a") != F.col("b")).distinct()
        # small star: every node hands its smaller neighbours, and itself, to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(least, "a").where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        links = materialise(small.unionByName(least.select("a", F.col("_m").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # settled: every node links to its least node alone
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
