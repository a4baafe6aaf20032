"""The largest values of each group, ties at the edge included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.joins import join_null_safe, one_row
from marketlens.operators.order_stats import running_totals, units, value_cells


def top_with_ties(df: DataFrame, value: str, scale: int, n: int,
                  keys: list[str] | None = None) -> DataFrame:
    """Rows whose value is at least the n-th largest of their group; NULL values never are.

    The n-th value comes from one cell per distinct value, and the rows are then filtered by it: they
    are neither sorted nor numbered. A group of fewer rows is returned whole.
    """
    keys = keys or []
    cells = value_cells(df, keys, value, scale)
    ahead = F.col("_total") - F.col("_before") - F.col("_n")
    edge = running_totals(cells, keys, "_unit", "_n").filter(ahead < n).groupBy(*keys).agg(
        F.min("_unit").alias("_edge"))
    met = join_null_safe(df, edge, keys) if keys else one_row(df, edge)
    return met.filter(units(value, scale) >= F.col("_edge")).drop("_edge")
