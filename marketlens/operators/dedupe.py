"""Duplicate keys. One key may hold a third of the rows, so no hot key is windowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.operators.hot import HOT_ROWS, hot_buckets, split_hot
from marketlens.operators.joins import join_null_safe


def _join_on_keys(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Attach one row per key; NULL keys match each other.

    There are about as many keys as rows, so this is never a broadcast. In the sort-merge join
    the adaptive optimizer splits the left partition of a hot key.
    """
    return join_null_safe(df, per_key.hint("merge"), keys, "left")


def flag_later_copies(df: DataFrame, keys: list[str], ordinal: str = "_ordinal",
                      flag: str = "_later_copy") -> DataFrame:
    """Mark every row that is not the first of its key in source order.

    The first ordinal per key is an aggregate with map-side combine, so the copies of a hot
    key collapse before the shuffle.
    """
    first = df.groupBy(*keys).agg(F.min(ordinal).alias("_first"))
    joined = _join_on_keys(df, first, keys)
    return joined.withColumn(flag, F.col(ordinal) > F.col("_first")).drop("_first")


def flag_stored_copies(df: DataFrame, keys: list[str], ordinal: str = "_ordinal",
                       flag: str = "_later_copy", limit: int = HOT_ROWS) -> DataFrame:
    """`flag_later_copies` for rows read from storage, which shuffles them once.

    The rows are counted by key hash first. Keys of usual size are ranked in their own shuffle,
    only those of hot buckets take the aggregate and the join.
    """
    usual, hot = split_hot(df, keys, hot_buckets(df, keys, limit))
    inside = Window.partitionBy(*keys).orderBy(ordinal)
    flagged = usual.withColumn(flag, F.rank().over(inside) > 1)
    return flagged if hot is None else flagged.unionByName(
        flag_later_copies(hot, keys, ordinal, flag))


def flag_all_copies(df: DataFrame, keys: list[str], flag: str = "_copied") -> DataFrame:
    """Mark every row of a key that occurs more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    joined = _join_on_keys(df, counts, keys)
    return joined.withColumn(flag, F.col("_copies") > 1).drop("_copies")


def keep_first(df: DataFrame, keys: list[str], ordinal: str = "_ordinal") -> DataFrame:
    """The first row of each key in source order."""
    return flag_later_copies(df, keys, ordinal).filter(~F.col("_later_copy")).drop("_later_copy")


def duplicate_count(key: str):
    """Rows beyond the first of each key value, NULL being one value."""
    return (F.count(F.lit(1)) - F.count_distinct(F.col(key))
            - F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0)))
