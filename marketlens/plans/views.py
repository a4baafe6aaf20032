"""The five reusable views over the curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.functions.calendar import month_of

Tables = dict[str, DataFrame]


def inquiry_analytics(t: Tables) -> DataFrame:
    """Inquiry grain with customer and vehicle attributes."""
    customers = t["dim_customer"].select(
        "customer_id", "customer_type", "age_group", "canton", "preferred_contact_method")
    vehicles = t["dim_vehicle"].select(
        "vehicle_id", "brand", "model", "vehicle_type", "fuel_type", "mileage_km",
        "mileage_bracket", "estimated_market_value", "vehicle_condition")
    return (t["fact_inquiry"].join(customers, "customer_id").join(vehicles, "vehicle_id").select(
        "inquiry_id", "inquiry_date", month_of("inquiry_date").alias("inquiry_month"), "status",
        "conversion_flag", "final_sale_price", "days_to_conversion", "quote_count",
        "highest_quote", "lowest_quote", "average_quote", "quote_spread", "quote_spread_pct",
        "fastest_response_hours", "vehicle_age_at_inquiry", "lead_source", "customer_type",
        "age_group", "canton", "preferred_contact_method", "brand", "model", "vehicle_type",
        "fuel_type", "mileage_km", "mileage_bracket", "estimated_market_value",
        "vehicle_condition", "winning_dealer_id"))


def quote_vehicle(t: Tables, quote_columns: list[str], vehicle_columns: list[str]) -> DataFrame:
    """Quotes with vehicle attributes. Inquiries take theirs first, so the large quote side is
    shuffled once, on the inquiry key."""
    inquiries = (t["fact_inquiry"].select("inquiry_id", "vehicle_id")
                 .join(t["dim_vehicle"].select("vehicle_id", *vehicle_columns), "vehicle_id")
                 .drop("vehicle_id"))
    return t["fact_quote"].select("inquiry_id", *quote_columns).join(inquiries, "inquiry_id")


def quote_competitiveness(t: Tables) -> DataFrame:
    """Quote grain with dealer and vehicle attributes."""
    quotes = quote_vehicle(
        t, ["quote_id", "dealer_id", "quote_date", "quote_amount", "response_time_hours",
            "quote_rank", "accepted_flag", "estimated_market_value", "quote_to_market_ratio",
            "anomaly_flag"], ["brand", "model", "vehicle_type"])
    dealers = t["dim_dealer"].select("dealer_id", "dealer_name", "dealer_region")
    return quotes.join(dealers, "dealer_id").select(
        "quote_id", "inquiry_id", "dealer_id", "dealer_name", "dealer_region", "quote_date",
        "quote_amount", "response_time_hours", "quote_rank", "accepted_flag",
        "estimated_market_value", "quote_to_market_ratio", "anomaly_flag", "brand", "model",
        "vehicle_type")


def dealer_performance(t: Tables) -> DataFrame:
    """Every dealer with its quote totals; quotes are aggregated before the outer join."""
    won = F.col("accepted_flag")
    totals = t["fact_quote"].groupBy("dealer_id").agg(
        F.count("quote_id").alias("_quotes"), N.count_where(won).alias("_wins"),
        N.mean_up("response_time_hours", 2).alias("average_response_time_hours"),
        N.mean_up("quote_to_market_ratio", 4).alias("average_quote_to_market_ratio"),
        F.sum(F.when(won, F.col("quote_amount"))).alias("accepted_quote_value"))
    quotes, wins = (F.coalesce(c, F.lit(0)) for c in ("_quotes", "_wins"))
    return t["dim_dealer"].join(totals, "dealer_id", "left").select(
        "dealer_id", "dealer_name", "dealer_region", "dealer_type", "dealer_rating",
        "active_flag", quotes.alias("total_quotes"), wins.alias("accepted_quotes"),
        N.ratio_up(wins, quotes, 4).alias("dealer_win_rate"), "average_response_time_hours",
        "average_quote_to_market_ratio", "accepted_quote_value")


def monthly_commercial_performance(t: Tables) -> DataFrame:
    sold = F.col("conversion_flag")
    return t["fact_inquiry"].groupBy(month_of("inquiry_date").alias("month")).agg(
        N.rows().alias("total_inquiries"), N.count_where(sold).alias("converted_inquiries"),
        N.rate_up(sold).alias("conversion_rate"),
        N.mean_up("final_sale_price", 2, sold).alias("average_sale_value"),
        N.mean_up("quote_spread", 2).alias("average_quote_spread"),
        N.mean_up("fastest_response_hours", 2).alias("average_fastest_response_hours"))


def data_quality_summary(t: Tables) -> DataFrame:
    return t["data_quality_metrics"].select(
        "assessment_date", "stage", "metric_name", "passed_records", "total_records", "rate",
        F.round(F.col("rate").cast("decimal(20,18)") * 100, 2).alias("rate_percent"),
        "description")


VIEWS = {
    "inquiry_analytics": inquiry_analytics,
    "quote_competitiveness": quote_competitiveness,
    "dealer_performance": dealer_performance,
    "monthly_commercial_performance": monthly_commercial_performance,
    "data_quality_summary": data_quality_summary,
}


def register_views(spark: SparkSession, t: Tables) -> None:
    """Expose the tables and views to spark.sql under their own names."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(t).createOrReplaceTempView(f"vw_{name}")
