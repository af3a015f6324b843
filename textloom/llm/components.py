"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.storage import discard, materialise


def _state(edges: DataFrame) -> tuple[int, int]:
    """Edge count and a checksum: equal after a round that changed nothing."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge and the smallest node it can reach.

    Each round is a few joins on nodes with an edge; the number of rounds grows
    with the logarithm of the longest chain. Each is written before the next.
    """
    larger, smaller = F.greatest(a, b), F.least(a, b)
    now = materialise(edges.where(F.col(a) != F.col(b)).select(larger.alias("u"), smaller.alias("v")).distinct(), "star")
    before = _state(now)
    while before[0]:
        now, done = materialise(_small_star(_large_star(now)), "star"), now
        discard(done)
        after = _state(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
