"""Top lists that keep their ties, and percentiles from sketches beside the exact ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.joins import join_null_safe
from marketlens.operators.order_stats import exact_percentiles, units
from marketlens.operators.sketches import (
    RANK_ERROR, merged_sketches, quantile_sketches, sketch_percentiles,
)
from marketlens.operators.top import top_with_ties

Tables = dict[str, DataFrame]


def most_quoted_inquiries(t: Tables, n: int = 50) -> DataFrame:
    """The inquiries of each lead source with the most quotes, and all that tie with the last."""
    return top_with_ties(t["fact_inquiry"], "quote_count", 0, n, ["lead_source"]).select(
        "lead_source", "inquiry_id", "quote_count")


def highest_quotes(t: Tables, n: int = 100) -> DataFrame:
    """The highest quotes of all, and all that tie with the last."""
    return top_with_ties(t["fact_quote"], "quote_amount", 2, n).select(
        "quote_id", "inquiry_id", "quote_amount")


def response_percentiles(t: Tables) -> DataFrame:
    """Fastest response by lead source: exact median, and whether the sketches keep their bound.

    Sketches are made by source and status and merged by source, as stored ones would be. A sketched
    value keeps the bound if rows up to `RANK_ERROR` off could stand at its fraction.
    """
    rows, value, scale = t["fact_inquiry"], "fastest_response_hours", 2
    fractions = {"median": (1, 2), "p90": (9, 10)}
    fine = quantile_sketches(rows, ["lead_source", "status"], value, scale)
    close = sketch_percentiles(merged_sketches(fine, ["lead_source"]), ["lead_source"], scale,
                               fractions)
    met = join_null_safe(rows.filter(F.col(value).isNotNull()).select("lead_source", value),
                         close, ["lead_source"])
    bounds = []
    for name, (top, bottom) in fractions.items():
        below = F.count_if(units(value, scale) < units(name, scale)) / F.count(F.lit(1))
        upto = F.count_if(units(value, scale) <= units(name, scale)) / F.count(F.lit(1))
        bounds.append(((below <= top / bottom + RANK_ERROR) & (upto >= top / bottom - RANK_ERROR))
                      .alias(f"{name}_within"))
    held = met.groupBy("lead_source").agg(F.count(F.lit(1)).alias("inquiries"), *bounds)
    exact = exact_percentiles(rows, ["lead_source"], value, scale, {"median_hours": (1, 2)})
    return join_null_safe(held, exact, ["lead_source"])


EXTREMES = {
    "top_most_quoted_inquiries": most_quoted_inquiries,
    "top_highest_quotes": highest_quotes,
    "sketched_response_percentiles": response_percentiles,
}
