"""Connected components of an edge table by alternating stars, in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    out = both.join(least, "a").where(F.col("b") > F.col("a"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them (a > b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has an edge; the root is the smallest
    node reachable.  ``edges`` has two columns of one orderable type.

    Each pass is joins and partial aggregates over the edge table, written to
    the shared folder; only a count and a checksum reach the driver.  The
    number of passes grows with the logarithm of the largest component.
    """
    a, b = edges.columns
    pair = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    now = keep(pair.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sums = F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    before = tuple(now.agg(*sums).first())
    while before[0]:
        now = keep(_small_star(_large_star(now)), "edges")
        after = tuple(now.agg(*sums).first())
        if after == before:
            break
        before = after
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
