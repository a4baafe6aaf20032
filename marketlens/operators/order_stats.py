"""Exact order statistics without sorting a group in one task.

A decimal of fixed scale is a whole number of units. Rows first collapse to one cell per
distinct value (map-side combine, so a hot group or hot value shrinks before the shuffle).
Running totals over the cells are then taken level by level, values inside blocks and blocks inside
larger blocks, so no window partition holds more than `BLOCK` values whatever their range.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.operators.joins import join_null_safe
from marketlens.session import cut


def units(value: str | Column, scale: int) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return (value * 10 ** scale).cast("bigint")


BLOCK = 4096


def running_totals(cells: DataFrame, keys: list[str], unit: str, weight: str,
                   tie: tuple[str, ...] = ()) -> DataFrame:
    """Add `_before`, the weight ordered ahead of the cell in its group, and `_total`.

    `cells` are stored, so their bounds are one row of statistics away.
    """
    low, high = cells.agg(F.min(unit), F.max(unit)).first()
    low, width = low or 0, (high or 0) - (low or 0) + 1
    place = F.col(unit).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
    placed = cells.withColumn("_b0", place.cast("bigint"))
    return _level(placed, keys, weight, "_b0", (unit, *tie), width, 0).drop("_b0")


def _level(cells: DataFrame, keys: list[str], weight: str, block: str, order: tuple[str, ...],
           width: int, depth: int) -> DataFrame:
    """Running totals in blocks of BLOCK units, on the totals of the blocks one level up."""
    earlier = (Window.unboundedPreceding, -1)
    if width <= BLOCK:
        group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        return cells.withColumns({
            "_before": F.coalesce(F.sum(weight).over(
                group.orderBy(*order).rowsBetween(*earlier)), F.lit(0)),
            "_total": F.sum(weight).over(group)})
    upper = f"_b{depth + 1}"
    blocked = cells.withColumn(upper, F.expr(f"{block} div {BLOCK}"))
    sums = blocked.groupBy(*keys, upper).agg(F.sum(weight).alias("_w"))
    above = _level(sums, keys, "_w", upper, (upper,), -(-width // BLOCK), depth + 1).select(
        *keys, upper, F.col("_before").alias("_base"), "_total")
    inside = Window.partitionBy(*keys, upper).orderBy(*order).rowsBetween(*earlier)
    return (join_null_safe(blocked, above, [*keys, upper])
            .withColumn("_before", F.col("_base")
                        + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .drop("_base", upper))


def value_cells(df: DataFrame, keys: list[str], value: str, scale: int) -> DataFrame:
    """Stored (keys, `_unit`, `_n`): one row per distinct value of a group.

    Only this pass reads the data; everything after it works on the cells.
    """
    return cut(df.filter(F.col(value).isNotNull())
               .groupBy(*keys, units(value, scale).alias("_unit"))
               .agg(F.count(F.lit(1)).alias("_n")))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, scale: int,
                      fractions: dict[str, tuple[int, int]], size: str | None = None) -> DataFrame:
    """Interpolated percentiles per group; a fraction is (numerator, denominator).

    `size` names a column for the number of values, when the caller wants it.
    """
    return cell_percentiles(value_cells(df, keys, value, scale), keys, scale, fractions, size)


def cell_percentiles(cells: DataFrame, keys: list[str], scale: int,
                     fractions: dict[str, tuple[int, int]], size: str | None = None) -> DataFrame:
    """Percentiles from cells; coarser keys may be used than the cells were made for."""
    if set(cells.columns) != {*keys, "_unit", "_n"}:
        cells = cut(cells.groupBy(*keys, "_unit").agg(F.sum("_n").alias("_n")))
    placed = running_totals(cells, keys, "_unit", "_n")
    aggregates = []
    for name, (top, bottom) in fractions.items():
        place = (F.col("_total") - 1) * top
        low = F.expr(f"((_total - 1) * {top}) div {bottom}")
        high = low + (place % bottom > 0).cast("int")
        for side, k in (("lo", low), ("hi", high)):
            covers = (F.col("_before") <= k) & (k < F.col("_before") + F.col("_n"))
            aggregates.append(F.max(F.when(covers, F.col("_unit"))).alias(f"{name}_{side}"))
    picked = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *aggregates)
    results = [F.col("_total").alias(size)] if size else []
    for name, (top, bottom) in fractions.items():
        lo, hi = (F.col(f"{name}_{side}").cast("decimal(18,0)") for side in ("lo", "hi"))
        part = ((F.col("_total") - 1) * top % bottom).cast("decimal(4,0)") / F.lit(bottom)
        exact = (lo + (hi - lo) * part.cast("decimal(6,4)")).cast("decimal(22,4)")
        unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale},{scale})")
        results.append((exact * unit).cast(f"decimal(28,{scale + 4})").alias(name))
    return picked.select(*keys, *results)


def _ranks(cells: DataFrame, keys: list[str], name: str, method: str,
           descending: bool) -> DataFrame:
    """(keys, `_ranked`, rank) of every distinct value from cells (keys, `_unit`, `_n`)."""
    cells = cut(cells)
    if method == "dense_rank":
        cells = cells.withColumn("_n", F.lit(1))
    placed = running_totals(cells, keys, "_unit", "_n")
    ahead = F.col("_total") - F.col("_before") - F.col("_n") if descending else F.col("_before")
    if method == "percent_rank":
        rank = F.when(F.col("_total") > 1, ahead / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    else:
        rank = (ahead + 1).cast("bigint")
    return placed.select(*keys, F.col("_unit").alias("_ranked"), rank.alias(name))


def value_ranks(df: DataFrame, unit: str, name: str, method: str = "rank",
                descending: bool = False, within: list[str] | None = None) -> DataFrame:
    """`rank`, `dense_rank` or `percent_rank` of a whole-number column over all rows or groups.

    Ranks are computed per distinct value and joined back; rows with a NULL value get NULL.
    """
    within = within or []
    cells = (df.filter(F.col(unit).isNotNull()).groupBy(*within, F.col(unit).alias("_unit"))
             .agg(F.count(F.lit(1)).alias("_n")))
    ranks = _ranks(cells, within, name, method, descending)
    return join_null_safe(df, ranks.withColumnRenamed("_ranked", unit), [*within, unit], "left")


def several_ranks(df: DataFrame, key: str, columns: dict[str, Column],
                  method: str = "rank") -> DataFrame:
    """(key, one rank per column): the columns are stacked and ranked in a single pass."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("_which"), unit.cast("bigint").alias("_unit"))
        for name, unit in columns.items()]))
    stacked = df.select(key, entries.alias("_e")).select(key, "_e.*").filter(
        "_unit is not null")
    cells = stacked.groupBy("_which", "_unit").agg(F.count(F.lit(1)).alias("_n"))
    ranks = _ranks(cells, ["_which"], "_rank", method, False).withColumnRenamed(
        "_which", "_column")
    return (stacked.join(ranks, (F.col("_which") == F.col("_column"))
                         & (F.col("_unit") == F.col("_ranked")))
            .groupBy(key).agg(*[F.max(F.when(F.col("_which") == name, F.col("_rank")))
                                .alias(name) for name in columns]))


def tile_summary(df: DataFrame, tiles: int, value: str, scale: int, flag: str,
                 tile_name: str) -> DataFrame:
    """NTILE over all rows ordered by (value, flag), summarised per tile.

    Rows equal in value and flag are interchangeable for the summary, so cells are split
    arithmetically at the tile edges and no row is ever numbered.
    """
    cells = cut(df.groupBy(units(value, scale).alias("_unit"), F.col(flag).alias("_flag"))
                .agg(F.count(F.lit(1)).alias("_n")))
    placed = running_totals(cells, [], "_unit", "_n", tie=("_flag",))
    quotient, extra = F.expr(f"_total div {tiles}"), F.expr(f"_total % {tiles}")
    start = quotient * F.col("_tile") + F.least(F.col("_tile"), extra)
    following = F.col("_tile") + 1
    end = quotient * following + F.least(following, extra)
    overlap = F.greatest(F.lit(0), F.least(end, F.col("_before") + F.col("_n"))
                         - F.greatest(start, F.col("_before")))
    return (placed.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
            .withColumn("_overlap", overlap).filter("_overlap > 0")
            .groupBy((F.col("_tile") + 1).alias(tile_name))
            .agg(F.sum("_overlap").alias("rows"),
                 (F.min("_unit").cast("decimal(20,0)") / 10 ** scale).alias("lowest"),
                 (F.max("_unit").cast("decimal(20,0)") / 10 ** scale).alias("highest"),
                 F.coalesce(F.sum(F.when(F.col("_flag"), F.col("_overlap"))), F.lit(0))
                 .alias("flagged")))
