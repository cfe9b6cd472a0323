"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b; any order, no loops) to node and component (its smallest node), for
    the nodes that have an edge.

    Alternates two steps until nothing changes: every node hands the smallest node it
    knows to its larger neighbours, then to its smaller ones. Both are a minimum per node
    (combined before the shuffle) joined to the edges, so the neighbours of a node never
    meet in one place. Each round is written to the shared checkpoint folder.
    """
    now = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        others = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = settled(others.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        changed, mark = mark, _mark(new)
        if mark == changed:
            break
        now = new
    stars = new.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets."""
    mixed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(mixed), F.lit(0)), F.coalesce(F.sum(mixed % 1_000_003), F.lit(0)))
    return tuple(row.first())
