"""Joins with stated cardinality, key audits, spines and frame comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import cut


class CardinalityError(ValueError):
    """A join key is not unique on a side declared unique."""


def is_unique(df: DataFrame, keys: list[str]) -> bool:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def checked_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                 validate: str = "m:1") -> DataFrame:
    """Join after asserting 1:1, 1:m or m:1 uniqueness of the keys."""
    left_side, right_side = validate.split(":")
    for side, df, name in ((left_side, left, "left"), (right_side, right, "right")):
        if side == "1" and not is_unique(df, keys):
            raise CardinalityError(f"{name} side is not unique on {keys} for a {validate} join")
    return left.join(right, keys, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL, keeping the left keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def lookup(left: DataFrame, right: DataFrame, key: str | Column, right_key: str,
           columns: dict[str, str]) -> DataFrame:
    """Left join to a table unique on `right_key`, bringing the renamed columns.

    No broadcast hint: the optimizer broadcasts a side whose measured size allows it and
    otherwise sort-merges, splitting hot keys at run time.
    """
    key = F.col(key) if isinstance(key, str) else key
    side = right.select(F.col(right_key).alias("_lookup_key"),
                        *[F.col(source).alias(target) for source, target in columns.items()])
    return left.join(side, key == F.col("_lookup_key"), "left").drop("_lookup_key")


def unknown_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Stored `_unknown`: the distinct foreign keys that the parent lacks, without NULL.

    Looking these few up spares the child a shuffle by a key as hot as its busiest parent.
    """
    used = child.select(F.col(foreign_key).alias("_unknown")).filter(
        "_unknown is not null").distinct()
    known = parent.select(F.col(key).alias("_p"))
    return cut(used.join(known, F.col("_unknown") == F.col("_p"), "left_anti"))


def orphan_counts(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """(checked, resolved, orphans) in one row; a NULL foreign key resolves.

    The child collapses to one row per key value before the join, so a hot key costs nothing.
    """
    used = child.groupBy(F.col(foreign_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(key).alias("_p")).filter("_p is not null").distinct()
    missing = F.col("_k").isNotNull() & F.col("_p").isNull()
    return (used.join(known, F.col("_k") == F.col("_p"), "left")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
                 F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("orphans"))
            .select("checked", (F.col("checked") - F.col("orphans")).alias("resolved"), "orphans"))


def spine_join(spine: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Every label of the spine, with NULL measures where no fact has it."""
    return spine.join(facts, key, "left")


def compare_by_key(left: DataFrame, right: DataFrame, key: str,
                   columns: dict[str, float]) -> DataFrame:
    """Keys on which the frames differ by more than the tolerance, or that one side lacks."""
    a = left.select(key, *[F.col(c).alias(f"left_{c}") for c in columns], F.lit(True).alias("_l"))
    b = right.select(key, *[F.col(c).alias(f"right_{c}") for c in columns], F.lit(True).alias("_r"))
    differs = [
        ~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}"))
        & F.coalesce(F.abs(F.col(f"left_{c}") - F.col(f"right_{c}")) > tolerance, F.lit(True))
        for c, tolerance in columns.items()]
    absent = F.col("_l").isNull() | F.col("_r").isNull()
    return (a.join(b, key, "full").filter(reduce(lambda x, y: x | y, differs, absent))
            .drop("_l", "_r"))


def one_row(df: DataFrame, single: DataFrame) -> DataFrame:
    """Attach the columns of an ungrouped aggregate, which is one row by construction."""
    return df.crossJoin(F.broadcast(single))
