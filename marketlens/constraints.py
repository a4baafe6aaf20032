"""Constraints every table declares, curated and operational, for the check compiler.

Columns must be present unless listed as optional; a domain holds for a NULL, which is a matter of the
column being present. Widths of text columns are left to the database.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.operators.checks import Reference, Unique, key_results
from marketlens.operators.rules import passed_counts
from marketlens.schema import KEYS, LOAD_ORDER, curated_schema

# --- Fixed values: keys, optional columns and links of the relational schema -------------------
PRIMARY_KEYS = {table: (key,) for table, key in KEYS.items()} | {
    "data_quality_metrics": ("metric_name", "stage", "assessment_date"),
    "data_quality_issue_log": ("issue_id",),
    "quarantined_records": ("quarantine_id",),
    "pipeline_run_summary": ("table_name",),
}
OPTIONAL = {"fact_inquiry": ("final_sale_price", "winning_dealer_id", "days_to_conversion")}
LINKS = [
    ("fact_inquiry", "customer_id", "dim_customer"),
    ("fact_inquiry", "vehicle_id", "dim_vehicle"),
    ("fact_inquiry", "inquiry_date", "dim_date"),
    ("fact_inquiry", "winning_dealer_id", "dim_dealer"),
    ("fact_quote", "inquiry_id", "fact_inquiry"),
    ("fact_quote", "dealer_id", "dim_dealer"),
    ("fact_quote", "quote_date", "dim_date"),
]


def _unless_null(rule, column: str) -> Column:
    return F.col(column).isNull() | rule(column)


def domains() -> dict[str, dict[str, Column]]:
    """Row rules by table and name."""
    price, winner = F.col("final_sale_price").isNotNull(), F.col("winning_dealer_id").isNotNull()
    return {
        "dim_date": {"month_range": F.col("month").between(1, 12),
                     "week_range": F.col("week").between(1, 53)},
        "dim_vehicle": {"vehicle_year": _unless_null(N.valid_year, "manufacture_year"),
                        "vehicle_mileage": _unless_null(N.valid_mileage, "mileage_km"),
                        "vehicle_value": F.col("estimated_market_value") > 0},
        "dim_dealer": {"dealer_rating": _unless_null(N.valid_rating, "dealer_rating")},
        "fact_inquiry": {
            "status_domain": F.col("status").isin("Converted", "Lost", "Expired", "Open"),
            "quote_count_positive": F.col("quote_count") > 0,
            "spread_not_negative": F.col("quote_spread") >= 0,
            "spread_pct_not_negative": F.col("quote_spread_pct") >= 0,
            "age_not_negative": F.col("vehicle_age_at_inquiry") >= 0,
            "conversion_consistency": F.when(F.col("conversion_flag"), price & winner)
            .otherwise(~price & ~winner)},
        "fact_quote": {
            "amount_range": _unless_null(N.valid_quote_amount, "quote_amount"),
            "hours_not_negative": F.col("response_time_hours") >= 0,
            "rank_positive": F.col("quote_rank") > 0,
            "value_positive": F.col("estimated_market_value") > 0,
            "ratio_positive": F.col("quote_to_market_ratio") > 0},
        "data_quality_metrics": {"stage_domain": F.col("stage").isin("Raw", "Processed"),
                                 "rate_range": F.col("rate").between(0, 1)},
        "data_quality_issue_log": {"rows_not_negative": F.col("affected_rows") >= 0},
    }


def schema_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, kind, check, passed, checked) of every declared constraint.

    Columns and domains take one pass per table; all keys and links one more and a single shuffle.
    """
    rules, parts = domains(), []
    for table in LOAD_ORDER:
        required = [c for c in curated_schema(table).fieldNames() if c not in OPTIONAL.get(table, ())]
        checks = {f"{table}|not_null|{c}": F.col(c).isNotNull() for c in required}
        checks |= {f"{table}|domain|{name}": F.coalesce(rule, F.lit(True))
                   for name, rule in rules.get(table, {}).items()}
        parts.append(passed_counts(tables[table], checks))
    parts.append(key_results(
        tables,
        [Unique(f"{t}|primary_key|{', '.join(key)}", t, key) for t, key in PRIMARY_KEYS.items()],
        [Reference(f"{t}|reference|{c}", t, (c,), parent, PRIMARY_KEYS[parent])
         for t, c, parent in LINKS]).drop("kind"))
    name = F.split("check", r"\|")
    return reduce(lambda a, b: a.unionByName(b), parts).select(
        name[0].alias("table_name"), name[1].alias("kind"), name[2].alias("check"),
        "passed", "checked")
