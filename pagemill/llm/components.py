"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("least"))
    return both.join(least, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst")).where("src <> dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.union(least.select("src", F.col("least").alias("dst"))).where("src <> dst").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells sets of distinct edges apart: their number and the exclusive ors of two 64-bit hashes of each."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")), F.bit_xor(F.xxhash64("dst", F.lit(1), "src"))).first())


def components(edges: DataFrame, stage: Staging, name: str = "cc") -> DataFrame:
    """``node, root`` for each node of ``edges`` (src, dst long) but the roots, root being the smallest node.

    Rows with nulls and self-links are ignored; an empty input gives an empty result. Each round
    is two grouped minima and two equi-joins on the node; the minima are combined before the
    shuffle and AQE splits a hub's rows, so no node is gathered in one task. Rounds grow with
    the logarithm of the longest path. Ends when a round changes nothing.
    """
    edges = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges = stage.write(edges, f"{name}0")
    seen, k = _mark(edges), 0
    while True:
        k += 1
        edges = stage.write(_small_star(_large_star(edges)), f"{name}{k}")
        stage.drop(f"{name}{k - 1}")
        now = _mark(edges)
        if now == seen:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        seen = now
