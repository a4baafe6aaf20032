"""Consecutive numbers over unbounded row sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.operators.hot import split_hot
from marketlens.operators.joins import join_null_safe
from marketlens.session import Workspace


def range_numbered(workspace: Workspace, df: DataFrame, stage: str, order: list[Column],
                   number: str, within: list[str] | None = None) -> DataFrame:
    """Exact row_number without one big sort: range slices, then an offset per slice.

    The slices are written once and sorted, because a sampled range partitioning may cut differently
    when it is computed again. A row's number is its place in the stored slice and its offset.
    """
    within = within or []
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c) for c in within], *order]
    cut = df.repartitionByRange(slices, *keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id())
    cut = workspace.stage(cut.withColumn("_slice", F.shiftright("_at", 33)), stage)
    earlier = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))) \
        .orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*within, "_slice").agg(
        F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(*within, "_slice", (
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start") + 1).alias("_offset"))
    # Without groups there is one row per slice, a bound for the broadcast.
    offsets = offsets if within else F.broadcast(offsets)
    return (join_null_safe(cut, offsets, [*within, "_slice"])
            .withColumn(number, (F.col("_at") + F.col("_offset")).cast("int"))
            .drop("_at", "_slice", "_offset"))


def number_within(workspace: Workspace, df: DataFrame, stage: str, key: str,
                  order: list[Column], number: str) -> DataFrame:
    """row_number per key on one plan for every size: range slices by key and order.

    A slice numbers its own rows, so a key of any size is spread over slices. Only the last key of
    a slice can go on in the next one, so there is at most one offset per slice, which is a bound
    for the broadcasts.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = workspace.stage(df.repartitionByRange(slices, F.col(key), *order)
                          .withColumn("_slice", F.spark_partition_id()), stage)
    tops = cut.groupBy("_slice").agg(F.max(F.struct(F.col(key).alias("k"))).alias("_top"))
    tops = tops.select("_slice", F.col("_top.k").alias(key))
    counts = join_null_safe(cut, F.broadcast(tops), [key, "_slice"]).groupBy(key, "_slice").agg(
        F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumns({  # one row per slice
        "_offset": F.sum("_n").over(Window.partitionBy(key).orderBy("_slice")),
        "_next": F.lead("_slice").over(Window.partitionBy(F.lit(0)).orderBy("_slice"))})
    offsets = offsets.filter("_next is not null").select(
        key, F.col("_next").alias("_slice"), "_offset")
    inside = Window.partitionBy(key, "_slice").orderBy(*order)
    return (join_null_safe(cut, F.broadcast(offsets), [key, "_slice"], "left")
            .withColumn(number, F.row_number().over(inside) + F.coalesce("_offset", F.lit(0)))
            .drop("_slice", "_offset"))


def number_groups(workspace: Workspace, df: DataFrame, stage: str, key: str, order: list[Column],
                  number: str, hot: list[int]) -> DataFrame:
    """row_number per key: a window on the shuffle the rows have, range slices for hot buckets."""
    usual, large = split_hot(df, [key], hot)
    numbered = usual.withColumn(
        number, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return numbered if large is None else numbered.unionByName(
        number_within(workspace, large, stage, key, order, number))
