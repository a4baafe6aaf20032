"""Ordered reject rules: a row is charged to the first rule it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first failing rule, NULL for a row that passes; an unknown outcome fails."""
    chain = None
    for name, fails in rules:
        fails = F.coalesce(fails, F.lit(True))
        chain = F.when(fails, name) if chain is None else chain.when(fails, name)
    return chain


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("_rule").isNull())


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("_rule").isNotNull())


def passed_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass over a table: (check, passed, checked) per predicate; NULL does not pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count(F.when(holds, 1)).alias(f"c{i}") for i, holds in enumerate(checks.values())])
    entries = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("passed"))
        for i, name in enumerate(checks)])
    return (wide.select("_rows", F.explode(entries).alias("e"))
            .select("e.check", "e.passed", F.col("_rows").alias("checked")))
