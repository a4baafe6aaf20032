"""Parsing, rounding and ratios. Money stays decimal so sums are exact and order-free."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.text import _col, clean_text
from marketlens.schema import (
    MAX_MILEAGE, MAX_QUOTE_AMOUNT, RATING_RANGE, RATIO_RANGE, WILSON_Z, YEAR_RANGE,
)

PARSED = "decimal(18,6)"
COUNT = "decimal(20,0)"


def to_number(value: str | Column, kind: str = PARSED) -> Column:
    """Unparsable text becomes NULL."""
    return clean_text(value).try_cast(kind)


def to_day(value: str | Column) -> Column:
    return clean_text(value).try_cast("date")


def within(value: Column, low, high) -> Column:
    """Inside the closed range; NULL is outside."""
    return F.coalesce(value.between(low, high), F.lit(False))


def valid_mileage(value: str | Column) -> Column:
    return mileage_in_range(to_number(value))


def mileage_in_range(number: Column) -> Column:
    return within(number, 0, MAX_MILEAGE)


def valid_quote_amount(value: str | Column) -> Column:
    return amount_in_range(to_number(value))


def amount_in_range(number: Column) -> Column:
    return F.coalesce((number > 0) & (number <= MAX_QUOTE_AMOUNT), F.lit(False))


def valid_year(value: str | Column) -> Column:
    return year_in_range(to_number(value))


def year_in_range(number: Column) -> Column:
    return within(number, *YEAR_RANGE)


def valid_rating(value: str | Column) -> Column:
    return within(to_number(value), *RATING_RANGE)


def at_or_above(value: str | Column, floor) -> Column:
    return F.coalesce(to_number(value) >= floor, F.lit(False))


def above(value: str | Column, floor) -> Column:
    return F.coalesce(to_number(value) > floor, F.lit(False))


def date_sequence(later: Column, earlier: Column) -> Column:
    """Both dates present and in order."""
    return F.coalesce(later >= earlier, F.lit(False))


def fix_sign(value: Column) -> tuple[Column, Column]:
    """(is a plausible sign error, repaired value)."""
    wrong = F.coalesce((value < 0) & (F.abs(value) <= MAX_MILEAGE), F.lit(False))
    return wrong, F.when(wrong, F.abs(value)).otherwise(value)


def outside_market(ratio: Column) -> Column:
    """Soft anomaly: a missing ratio is anomalous too."""
    low, high = (F.lit(bound).cast("decimal(4,2)") for bound in RATIO_RANGE)
    return ~F.coalesce(ratio.between(low, high), F.lit(False))


# --- aggregates ----------------------------------------------------------------------------

def rows() -> Column:
    return F.count(F.lit(1))


def count_where(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def total(value: str | Column, where: Column | None = None) -> Column:
    """Exact sum, zero when nothing qualifies."""
    value = _col(value)
    return F.coalesce(F.sum(value if where is None else F.when(where, value)), F.lit(0))


def ratio(top: Column, bottom: Column) -> Column:
    """Exact decimal quotient; NULL when the denominator is zero."""
    return F.try_divide(top, F.nullif(bottom.cast(COUNT), F.lit(0).cast(COUNT)))


def ratio_up(top: Column, bottom: Column, digits: int) -> Column:
    """Quotient of two counts, rounded half away from zero."""
    return F.round(ratio(top.cast(COUNT), bottom), digits)


def mean_up(value: str | Column, digits: int, where: Column | None = None,
            factor: int = 1) -> Column:
    """Decimal mean rounded half away from zero, as a NUMERIC column would round it."""
    value = _col(value)
    value = value if where is None else F.when(where, value)
    return F.round(ratio(F.sum(value) * factor, F.count(value)), digits)


def rate_up(flag: str | Column, digits: int = 4) -> Column:
    flag = _col(flag)
    return ratio_up(count_where(flag), F.count(flag), digits)


def mean(value: str | Column, where: Column | None = None) -> Column:
    """Unrounded mean: one exact decimal sum, one floating-point division."""
    value = _col(value)
    value = value if where is None else F.when(where, value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def rate(flag: str | Column) -> Column:
    flag = _col(flag)
    return F.try_divide(count_where(flag).cast("double"), F.count(flag).cast("double"))


def quotient(top: Column, bottom: Column) -> Column:
    """Floating-point division; NULL on a zero or missing denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def bounded_rate(passed: Column, checked: Column) -> Column:
    """Share of passed checks in [0, 1]; an empty check counts as perfect."""
    share = F.greatest(F.least(quotient(passed, checked), F.lit(1.0)), F.lit(0.0))
    return F.when(checked == 0, F.lit(1.0)).otherwise(share)


def wilson_interval(successes: Column, totals: Column) -> tuple[Column, Column]:
    """95 % Wilson score interval of a binomial rate."""
    hits, n = successes.cast("double"), totals.cast("double")
    share, z2 = hits / n, WILSON_Z * WILSON_Z
    middle = (share + z2 / (n * 2)) / (z2 / n + 1)
    spread = F.sqrt(share * (1 - share) / n + z2 / (n * n * 4)) * WILSON_Z / (z2 / n + 1)
    return middle - spread, middle + spread
