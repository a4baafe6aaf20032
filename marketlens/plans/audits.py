"""The ten data-quality audits; the first nine count failures, the tenth is a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.operators.dedupe import duplicate_count
from marketlens.operators.joins import one_row, orphan_counts
from marketlens.plans.views import Tables
from marketlens.schema import MAX_MILEAGE, MAX_QUOTE_AMOUNT


def d01(t: Tables) -> DataFrame:
    """Primary-key duplicates of five tables."""
    keys = {"dim_customer": "customer_id", "dim_vehicle": "vehicle_id",
            "dim_dealer": "dealer_id", "fact_inquiry": "inquiry_id", "fact_quote": "quote_id"}
    return reduce(lambda a, b: a.unionByName(b), [
        t[table].agg(F.lit(f"{table}.{key}").alias("rule"),
                     duplicate_count(key).alias("failures")) for table, key in keys.items()])


def d02(t: Tables) -> DataFrame:
    """Mileage outside its domain."""
    km = F.col("mileage_km")
    return t["dim_vehicle"].filter(~km.between(0, MAX_MILEAGE) | km.isNull()).agg(
        N.rows().alias("invalid_mileage_rows"))


def d03(t: Tables) -> DataFrame:
    """Quote amount outside its domain."""
    amount = F.col("quote_amount")
    return t["fact_quote"].filter(
        (amount <= 0) | (amount > MAX_QUOTE_AMOUNT) | amount.isNull()).agg(
        N.rows().alias("invalid_quote_amount_rows"))


def _orphans(t: Tables, child: str, links: dict[str, tuple[str, str, str]]) -> DataFrame:
    """One row of orphan counts; unlike the load check, a NULL key counts as an orphan here."""
    result = None
    for name, (foreign, parent, key) in links.items():
        absent = t[child].filter(F.col(foreign).isNull()).agg(N.rows().alias("_absent"))
        found = orphan_counts(t[child], foreign, t[parent], key).select("orphans")
        count = one_row(found, absent).select((F.col("orphans") + F.col("_absent")).alias(name))
        result = count if result is None else one_row(result, count)
    return result


def d04(t: Tables) -> DataFrame:
    """Inquiries without customer or vehicle."""
    return _orphans(t, "fact_inquiry", {
        "orphan_customers": ("customer_id", "dim_customer", "customer_id"),
        "orphan_vehicles": ("vehicle_id", "dim_vehicle", "vehicle_id")})


def d05(t: Tables) -> DataFrame:
    """Quotes without inquiry or dealer."""
    return _orphans(t, "fact_quote", {
        "orphan_inquiries": ("inquiry_id", "fact_inquiry", "inquiry_id"),
        "orphan_dealers": ("dealer_id", "dim_dealer", "dealer_id")})


def d06(t: Tables) -> DataFrame:
    """Quotes dated before their inquiry, counted per inquiry and day before the join."""
    quotes = t["fact_quote"].groupBy("inquiry_id", "quote_date").agg(N.rows().alias("_n"))
    return (quotes.join(t["fact_inquiry"].select("inquiry_id", "inquiry_date"), "inquiry_id")
            .filter(F.col("quote_date") < F.col("inquiry_date"))
            .agg(N.total("_n").alias("quote_before_inquiry_rows")))


def d07(t: Tables) -> DataFrame:
    """Converted without exactly one accepted quote, or not converted with any."""
    accepted = t["fact_quote"].groupBy("inquiry_id").agg(
        N.count_where(F.col("accepted_flag")).alias("_accepted"))
    expected = F.when(F.col("conversion_flag"), 1).otherwise(0)
    return (t["fact_inquiry"].select("inquiry_id", "conversion_flag")
            .join(accepted, "inquiry_id").filter(F.col("_accepted") != expected)
            .agg(N.rows().alias("invalid_accepted_quote_rules")))


def d08(t: Tables) -> DataFrame:
    """Winner that is not the dealer of the accepted quote."""
    accepted = t["fact_quote"].filter("accepted_flag").select("inquiry_id", "dealer_id")
    return (t["fact_inquiry"].select("inquiry_id", "winning_dealer_id")
            .join(accepted, "inquiry_id")
            .filter(~F.col("winning_dealer_id").eqNullSafe(F.col("dealer_id")))
            .agg(N.rows().alias("winning_dealer_mismatches")))


def d09(t: Tables) -> DataFrame:
    """Stored inquiry metrics that a recomputation does not confirm."""
    again = t["fact_quote"].groupBy("inquiry_id").agg(
        N.rows().alias("_count"), F.max("quote_amount").alias("_high"),
        F.min("quote_amount").alias("_low"))
    return (t["fact_inquiry"]
            .select("inquiry_id", "quote_count", "highest_quote", "lowest_quote", "quote_spread")
            .join(again, "inquiry_id").filter(
                (F.col("quote_count") != F.col("_count"))
                | (F.col("highest_quote") != F.col("_high"))
                | (F.col("lowest_quote") != F.col("_low"))
                | (F.col("quote_spread") != F.col("_high") - F.col("_low")))
            .agg(N.rows().alias("metric_discrepancies")))


def d10(t: Tables) -> DataFrame:
    """Issue log with the number of quarantined rows behind each issue."""
    held = t["quarantined_records"].groupBy("table_name", "issue_type").agg(
        N.rows().alias("_held"))
    return t["data_quality_issue_log"].join(held, ["table_name", "issue_type"], "left").groupBy(
        "table_name", "issue_type", "affected_rows", "action").agg(
        N.total("_held").alias("quarantined_rows")).orderBy(F.desc("affected_rows"))


AUDITS = {f"d{n:02d}": globals()[f"d{n:02d}"] for n in range(1, 11)}
