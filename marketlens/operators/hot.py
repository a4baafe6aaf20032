"""Keys that hold too many rows for one task, told apart before a window groups by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows are counted by a hash of their key, so a map task sends at most BUCKETS numbers whatever the
# number of keys. A window may hold HOT_ROWS rows of a bucket; more go an exact way without windows.
BUCKETS = 65_536
HOT_ROWS = 1_000_000


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS))


def hot_buckets(df: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> list[int]:
    """Hash buckets of the keys with more than `limit` rows; there are at most rows / limit."""
    counts = df.groupBy(_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [r.bucket for r in counts.filter(F.col("n") > limit).collect()]


def split_hot(df: DataFrame, keys: list[str], hot: list[int]) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose keys fit a window, and the rest, or None if there is no hot bucket."""
    if not hot:
        return df, None
    inside = _bucket(keys).isin(hot)
    return df.filter(~inside), df.filter(inside)


def copies_stay_within(df: DataFrame, key: str, group: str, limit: int = HOT_ROWS) -> bool:
    """Whether all rows of a key have one group, NULL being one, and no hash bucket is hot.

    Keys and groups go as 64-bit hashes, so that the shuffle is narrow and the aggregate needs no sort.
    """
    if hot_buckets(df, [key], limit):
        return False
    told = F.xxhash64(group)
    apart = df.groupBy(F.xxhash64(key).alias("k")).agg(F.min(told).alias("a"), F.max(told).alias("b"))
    return apart.filter("a != b").isEmpty()
