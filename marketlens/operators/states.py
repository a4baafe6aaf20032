"""Aggregates as mergeable states, so that facts shrink before they meet a dimension.

A measure names the states it keeps of its rows (sums, counts, least and greatest values) and how the
merged states become its value. `partial` makes states at the grain of the fact's foreign keys,
`merged` brings them to fewer or other keys any number of times, `finished` ends with the values. The
result is that of one aggregate over the joined rows, as long as a join adds no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import numbers as N

_START = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """States as (kind, value) and the value they end in.

    Columns are built on use: they belong to the session that is active then.
    """

    states: tuple[tuple[str, Callable[[], Column]], ...]
    finish: Callable[..., Column] = lambda state: state


def rows() -> Measure:
    return Measure((("count", lambda: F.lit(1)),))


def count_where(flag: Callable[[], Column]) -> Measure:
    return Measure((("count", lambda: F.when(flag(), 1)),))


def total(value: Callable[[], Column]) -> Measure:
    return Measure((("sum", value),))


def least(value: str) -> Measure:
    return Measure((("min", lambda: F.col(value)),))


def greatest(value: Callable[[], Column]) -> Measure:
    return Measure((("max", value),))


def mean(value: str, where: Callable[[], Column] | None = None) -> Measure:
    """Unrounded mean: one exact sum, one floating-point division."""
    def chosen() -> Column:
        return F.col(value) if where is None else F.when(where(), F.col(value))
    return Measure((("sum", chosen), ("count", chosen)), N.quotient)


def quotient_of_totals(top: str, bottom: str) -> Measure:
    return Measure((("sum", lambda: F.col(top)), ("sum", lambda: F.col(bottom))), N.quotient)


def _named(measures: dict[str, Measure]) -> list[tuple[str, str, Callable[[], Column]]]:
    return [(f"_{name}_{i}", kind, value) for name, measure in measures.items()
            for i, (kind, value) in enumerate(measure.states)]


def partial(df: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The keys and the states of their rows."""
    return df.groupBy(*keys).agg(*[_START[kind](value()).alias(name)
                                   for name, kind, value in _named(measures)])


def merged(states: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """States of the given keys from states of finer ones; types stay as they are."""
    columns = []
    for name, kind, _ in _named(measures):
        merge = F.sum(name) if kind in ("sum", "count") else _START[kind](name)
        if kind == "count":
            merge = F.coalesce(merge, F.lit(0))
        columns.append(merge.cast(states.schema[name].dataType).alias(name))
    return states.groupBy(*keys).agg(*columns)


def finished(states: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    return states.select(*keys, *[
        measure.finish(*[F.col(f"_{name}_{i}") for i in range(len(measure.states))]).alias(name)
        for name, measure in measures.items()])
