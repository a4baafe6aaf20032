"""Copies of keys, first rows, 1:1 joins, catalogue spellings and regions as tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.dedupe import flag_all_copies, keep_first
from marketlens.operators.joins import checked_join
from marketlens.operators.rules import passed
from marketlens.plans.clean import tag_vehicles
from marketlens.sources.raw import with_region

Tables = dict[str, DataFrame]


def copied_customers(raw: Tables) -> DataFrame:
    """Every raw customer row whose identifier occurs more than once."""
    return flag_all_copies(raw["dim_customer"], ["customer_id"]).filter("_copied").select(
        "customer_id", "canton")


def first_customers(raw: Tables) -> DataFrame:
    """The first raw row of each customer in source order."""
    return keep_first(raw["dim_customer"], ["customer_id"]).select("customer_id", "lead_source")


def quote_totals(t: Tables) -> DataFrame:
    """Inquiries with the number and latest day of their quotes; each side has one row per key."""
    totals = t["fact_quote"].groupBy("inquiry_id").agg(
        F.count(F.lit(1)).alias("quotes"), F.max("quote_date").alias("latest_quote"))
    return checked_join(t["fact_inquiry"].select("inquiry_id", "inquiry_date"), totals,
                        ["inquiry_id"], "left", validate="1:1")


def catalogued_vehicles(raw: Tables, catalog: DataFrame) -> DataFrame:
    """Vehicles with their brands in the catalogue's spelling."""
    return passed(tag_vehicles(raw["dim_vehicle"], catalog)).select("vehicle_id", "brand")


def customer_regions(t: Tables, regions: DataFrame) -> DataFrame:
    """Customers with the region of their canton."""
    return with_region(t["dim_customer"], regions).select(
        "customer_id", "canton", "customer_region")
