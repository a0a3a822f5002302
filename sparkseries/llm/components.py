"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.common import forget, stored


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge set; equal digests mean that a step changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge runs from the larger node u to the smaller node v
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(node, root)``: each linked node with the smallest node that it reaches.

    Each round is a few shuffles of the links and is written to the shared
    folder.  The number of rounds grows with the logarithm of the graph, and
    the driver sees a count and a digest of a round, never its links.  Nodes
    without a link have no row.  Repeated links, loops and either direction
    give the same result; an empty input gives an empty result.
    """
    now = stored(edges.where("u <> v").distinct(), "links")
    before = None
    while (state := _state(now)) != before:
        before = state
        moved = _small_star(_large_star(now)).where("u <> v").distinct()
        last, now = now, stored(moved, "links")
        forget(last)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
