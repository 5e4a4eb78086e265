"""Connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): every
round links nodes to the smallest node they know, with joins and aggregates
only, so a node with very many neighbours is aggregated before the shuffle
and its join can be split.  Rounds are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node that each
    node reaches; nodes without an edge to another node are absent."""
    e = materialize(edges.where("a != b").select("a", "b"), "edges")
    seen = None
    for _ in range(rounds):
        after = materialize(_small_star(_large_star(e)), "edges")
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(e)
        e = after
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
