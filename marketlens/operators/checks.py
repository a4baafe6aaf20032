"""Uniqueness and reference checks of any number of tables, compiled to one shuffle.

Every table is read once, whatever keys it declares or refers to. A row gives one entry per key, and
entries of equal value combine before the shuffle, so a hot value costs a few rows. The one aggregate
that follows has, for a value, how often its own table holds it and how often each referring column
does; that answers uniqueness and orphans together, without a join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Unique:
    """The columns identify a row of the table; NULL counts as one value."""
    check: str
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """The columns, unless NULL, occur among the key columns of the parent."""
    check: str
    table: str
    columns: tuple[str, ...]
    parent: str
    key: tuple[str, ...]


def _value(df: DataFrame, columns: tuple[str, ...], like: list) -> Column:
    """A key as text in the parent's types; a composite key with a NULL part is told apart."""
    parts = [F.col(c).try_cast(kind).cast("string") for c, kind in zip(columns, like)]
    return parts[0] if len(parts) == 1 else F.to_json(F.struct(*[
        part.alias(f"k{i}") for i, part in enumerate(parts)]))


def key_results(tables: dict[str, DataFrame], unique: list[Unique],
                references: list[Reference]) -> DataFrame:
    """(kind, check, passed, checked): one row per check, in one scan per table and one shuffle.

    A uniqueness check passes once per distinct value. An empty table gives zeros.
    """
    domains = list(dict.fromkeys([(u.table, u.columns) for u in unique]
                                 + [(r.parent, r.key) for r in references]))
    types = {(table, columns): [tables[table].schema[c].dataType for c in columns]
             for table, columns in domains}
    entries: dict[str, list[Column]] = {}
    roles: dict[Reference, int] = {}

    def enter(table: str, domain: tuple, role: int, columns: tuple[str, ...]) -> None:
        entries.setdefault(table, []).append(F.struct(
            F.lit(domains.index(domain)).alias("domain"), F.lit(role).alias("role"),
            _value(tables[table], columns, types[domain]).alias("value"),
            reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]).alias("blank")))

    for domain in domains:
        enter(domain[0], domain, 0, domain[1])
    for reference in references:
        domain = (reference.parent, reference.key)
        roles[reference] = 1 + sum((r.parent, r.key) == domain for r in roles)
        enter(reference.table, domain, roles[reference], reference.columns)

    used = reduce(lambda a, b: a.unionByName(b), [
        tables[t].select(F.explode(F.array(*found)).alias("e")).select("e.*")
        for t, found in entries.items()])
    counts = used.groupBy("domain", "value", "blank").agg(*[
        F.count_if(F.col("role") == role).alias(f"n{role}")
        for role in range(1 + max(roles.values(), default=0))])

    def total(amount: Column, domain: tuple) -> Column:
        here = F.col("domain") == domains.index(domain)
        return F.coalesce(F.sum(F.when(here, amount)), F.lit(0)).cast("bigint")

    sums, rows = [], []

    def report(kind: str, check: str, passed: Column, checked: Column) -> None:
        n = len(rows)
        sums.extend([passed.alias(f"p{n}"), checked.alias(f"c{n}")])
        rows.append(F.struct(F.lit(kind).alias("kind"), F.lit(check).alias("check"),
                             F.col(f"p{n}").alias("passed"), F.col(f"c{n}").alias("checked")))

    for u in unique:
        report("unique", u.check, total(F.least(F.col("n0"), F.lit(1)), (u.table, u.columns)),
               total(F.col("n0"), (u.table, u.columns)))
    for r in references:
        used_by = F.col(f"n{roles[r]}")
        resolved = F.when(F.col("blank") | (F.col("n0") > 0), used_by)
        report("reference", r.check, total(resolved, (r.parent, r.key)),
               total(used_by, (r.parent, r.key)))
    return counts.agg(*sums).select(F.explode(F.array(*rows)).alias("e")).select("e.*")
