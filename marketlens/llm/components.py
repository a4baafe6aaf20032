"""Connected components by alternating large-star and small-star steps (shuffles only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.store import stored


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(back) if larger_only else edges.where("v < u").unionByName(
        back.where("v < u"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    met = near.join(least, "u")
    if larger_only:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node reachable.

    Every round is stored, so nothing is recomputed and lost executors cost one round at most.
    A hub's neighbours are aggregated before the shuffle and its join can be split. Rounds grow
    with the logarithm of the longest chain. Empty edges give an empty result.
    """
    now = stored(edges.where("u <> v").distinct())
    state = None
    while True:
        after = stored(_star(_star(now, True).where("u <> v").distinct(), False)
                       .where("u <> v").distinct())
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == state or mark[0] == 0:
            roots = after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots)
        now, state = after, mark
