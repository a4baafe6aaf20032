"""Management evidence: scalar KPIs and the small tables behind them, unrounded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.functions.bands import band_below, band_upto
from marketlens.functions.calendar import label_spine, month_of
from marketlens.operators.joins import checked_join, one_row, spine_join
from marketlens.operators.order_stats import exact_percentiles
from marketlens.plans.views import Tables
from marketlens.schema import AGE_BANDS, RESPONSE_BANDS, SLA_HOURS
from marketlens.session import cut

FAST, SLOW = f"Under {SLA_HOURS} hours", f"{SLA_HOURS}+ hours"
REFERRAL, SOCIAL = "Dealer Referral", "Social Media"


def _inquiries() -> Column:
    return N.rows().alias("inquiries")


def _conversions() -> Column:
    return N.count_where(F.col("conversion_flag")).alias("conversions")


def _conversion_rate() -> Column:
    return N.rate("conversion_flag").alias("conversion_rate")


def _accepted_value() -> Column:
    return N.total("final_sale_price").alias("accepted_value")


def monthly(t: Tables) -> DataFrame:
    return t["fact_inquiry"].groupBy(month_of("inquiry_date").alias("month")).agg(
        _inquiries(), _conversions(), _conversion_rate(), _accepted_value()).orderBy("month")


def lead_sources(t: Tables) -> DataFrame:
    return t["fact_inquiry"].filter("lead_source is not null").groupBy("lead_source").agg(
        _inquiries(), _conversions(), _conversion_rate(),
        N.mean("final_sale_price").alias("average_sale_value"),
        N.mean("fastest_response_hours").alias("fastest_response_hours")
    ).orderBy(F.desc_nulls_last("conversion_rate"))


def response_bands(t: Tables) -> DataFrame:
    """Every band in order, also the empty ones."""
    band = band_below(F.col("fastest_response_hours"), RESPONSE_BANDS, floor=-0.01)
    found = t["fact_inquiry"].groupBy(band.alias("response_band")).agg(
        _inquiries(), _conversion_rate(),
        N.mean("final_sale_price").alias("average_sale_value"))
    spine = label_spine(found.sparkSession, "response_band", [x for _, x in RESPONSE_BANDS])
    return spine_join(spine, found, "response_band").orderBy("_order").drop("_order")


def age_bands(t: Tables) -> DataFrame:
    """Every band in order; ages at or below -1 belong to none."""
    band = band_upto(F.col("vehicle_age_at_inquiry"), AGE_BANDS, above=-1)
    found = t["fact_inquiry"].groupBy(band.alias("vehicle_age_band")).agg(
        _inquiries(), _conversion_rate(), N.mean("quote_spread").alias("average_quote_spread"),
        N.mean("quote_spread_pct").alias("average_quote_spread_pct"))
    spine = label_spine(found.sparkSession, "vehicle_age_band", [x for _, x in AGE_BANDS])
    return spine_join(spine, found, "vehicle_age_band").orderBy("_order").drop("_order")


def _inquiry_vehicle(t: Tables, attributes: list[str], validate: str) -> DataFrame:
    vehicles = t["dim_vehicle"].select("vehicle_id", "estimated_market_value", *attributes)
    inquiries = t["fact_inquiry"].select("vehicle_id", "conversion_flag", "final_sale_price")
    return checked_join(inquiries, vehicles, ["vehicle_id"], validate=validate)


def vehicle_segments(t: Tables, validate: str = "1:1") -> DataFrame:
    """By vehicle type; an appraised vehicle belongs to one inquiry unless told otherwise."""
    return _inquiry_vehicle(t, ["vehicle_type"], validate).filter(
        "vehicle_type is not null").groupBy("vehicle_type").agg(
        _inquiries(), _conversion_rate(),
        N.mean("estimated_market_value").alias("average_market_value"), _accepted_value()
    ).orderBy(F.desc_nulls_last("accepted_value"))


def brands(t: Tables, validate: str = "1:1", top: int | None = 10) -> DataFrame:
    ranked = _inquiry_vehicle(t, ["brand"], validate).filter("brand is not null").groupBy(
        "brand").agg(
        _inquiries(), _conversion_rate(),
        N.mean("estimated_market_value").alias("average_market_value"),
        N.mean("final_sale_price").alias("average_sale_value"), _accepted_value()
    ).orderBy(F.desc_nulls_last("accepted_value"), "brand")
    return ranked if top is None else ranked.limit(top)


def dealer_detail(t: Tables, top: int | None = None) -> DataFrame:
    """Dealers with quotes; the quotes collapse to dealers before they meet the names."""
    won = F.col("accepted_flag")
    totals = t["fact_quote"].groupBy("dealer_id").agg(
        N.rows().alias("quotes"), N.count_where(won).alias("wins"),
        N.rate(won).alias("win_rate"),
        N.mean("response_time_hours").alias("average_response_hours"),
        N.mean("quote_to_market_ratio").alias("average_quote_to_market_ratio"),
        N.total("quote_amount", won).alias("accepted_value"))
    names = t["dim_dealer"].select("dealer_id", "dealer_name", "dealer_region")
    ranked = checked_join(totals, names, ["dealer_id"], validate="m:1").select(
        "dealer_id", "dealer_name", "dealer_region", "quotes", "wins", "win_rate",
        "average_response_hours", "average_quote_to_market_ratio", "accepted_value"
    ).orderBy(F.desc_nulls_last("win_rate"), "dealer_id")
    return ranked if top is None else ranked.limit(top)


def annual(t: Tables) -> DataFrame:
    return t["fact_inquiry"].groupBy(F.year("inquiry_date").alias("year")).agg(
        _inquiries(), _conversion_rate(), _accepted_value()).orderBy("year")


def response_by_year(t: Tables) -> DataFrame:
    """Fast and slow first responses by year with a Wilson interval."""
    fast = F.coalesce(F.col("fastest_response_hours") < SLA_HOURS, F.lit(False))
    counted = t["fact_inquiry"].groupBy(
        F.year("inquiry_date").alias("year"),
        F.when(fast, FAST).otherwise(SLOW).alias("response_group")).agg(
        _inquiries(), _conversions())
    low, high = N.wilson_interval(F.col("conversions"), F.col("inquiries"))
    return counted.select(
        "*", N.quotient(F.col("conversions"), F.col("inquiries")).alias("conversion_rate"),
        low.alias("ci_95_low"), high.alias("ci_95_high")).orderBy("year", "response_group")


def _stability(rates: DataFrame, column: str, first: str, second: str, lift: str) -> DataFrame:
    """Years as rows, the two groups as columns, and their gap in percentage points."""
    wide = rates.groupBy("year").pivot(column, [first, second]).agg(F.first("conversion_rate"))
    return wide.withColumn(lift, (F.col(f"`{first}`") - F.col(f"`{second}`")) * 100).orderBy("year")


def response_stability(t: Tables) -> DataFrame:
    return _stability(response_by_year(t), "response_group", FAST, SLOW,
                      "lift_percentage_points")


def channel_by_year(t: Tables) -> DataFrame:
    return t["fact_inquiry"].filter(F.col("lead_source").isin(REFERRAL, SOCIAL)).groupBy(
        F.year("inquiry_date").alias("year"), "lead_source").agg(
        _inquiries(), _conversions(), _conversion_rate()).orderBy("year", "lead_source")


def channel_stability(t: Tables) -> DataFrame:
    return _stability(channel_by_year(t), "lead_source", REFERRAL, SOCIAL,
                      "referral_lift_percentage_points")


def quality_score(metrics: DataFrame, stage: str,
                  metric: str = "overall_data_quality_score") -> DataFrame:
    """One row with the rate of a stage and metric."""
    return metrics.filter((F.col("stage") == stage) & (F.col("metric_name") == metric)).agg(
        F.max("rate").cast("double").alias("rate"))


def metadata(t: Tables) -> DataFrame:
    return t["fact_inquiry"].agg(
        F.min("inquiry_date").alias("start_date"), F.max("inquiry_date").alias("end_date"),
        F.lit("Inquiry for conversion; quote for dealer competitiveness")
        .alias("analysis_grain"))


def unpivoted(one: DataFrame) -> DataFrame:
    """A one-row frame as (metric_name, value)."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric_name"), F.col(f"`{c}`").cast("double").alias("value"))
        for c in one.columns]))
    return one.select(entries.alias("e")).select("e.*")


def kpis(t: Tables) -> DataFrame:
    """The sixteen headline KPIs as (metric_name, value)."""
    flagged = F.col("anomaly_flag")
    inquiries = t["fact_inquiry"].agg(
        N.rows().alias("total_inquiries"),
        N.count_where(F.col("conversion_flag")).alias("converted_inquiries"),
        _conversion_rate(), N.mean("final_sale_price").alias("average_sale_value"),
        N.total("final_sale_price").alias("total_accepted_value"),
        N.mean("quote_spread").alias("average_quote_spread"),
        N.mean("quote_spread_pct").alias("average_quote_spread_pct"),
        N.mean("fastest_response_hours").alias("average_fastest_response_hours"),
        N.mean("quote_count").alias("average_quotes_per_inquiry"))
    quotes = t["fact_quote"].agg(
        N.rows().alias("total_quotes"),
        N.mean("response_time_hours").alias("average_quote_response_hours"),
        N.count_where(flagged).alias("quote_anomalies"),
        N.rate(flagged).alias("quote_anomaly_rate"))
    dealers = t["dim_dealer"].agg(
        N.count_where(F.col("active_flag")).alias("active_dealers"))
    scores = [quality_score(t["data_quality_metrics"], stage)
              .withColumnRenamed("rate", f"{stage.lower()}_data_quality_score")
              for stage in ("Raw", "Processed")]
    return unpivoted(reduce(one_row, [quotes, dealers, *scores], inquiries))


def evidence(t: Tables, validate: str = "1:1", segment: str = "Suv",
             first_year: int = 2022, last_year: int = 2025) -> DataFrame:
    """The twenty-one evidence scalars as (metric_name, value)."""
    sold, won = F.col("conversion_flag"), F.col("accepted_flag")
    fast = F.coalesce(F.col("fastest_response_hours") < SLA_HOURS, F.lit(False))
    year, source = F.year("inquiry_date"), F.col("lead_source")
    age = F.col("vehicle_age_at_inquiry")

    def rate_of(group: Column) -> Column:
        return N.quotient(N.count_where(group & sold), N.count_where(group))

    referral, social = rate_of(source == REFERRAL), rate_of(source == SOCIAL)
    inquiries = t["fact_inquiry"].agg(
        (N.quotient(N.count_where(year == last_year), N.count_where(year == first_year)) - 1)
        .alias(f"inquiry_growth_{first_year}_to_{last_year}"),
        rate_of(fast).alias("conversion_under_8_hours"),
        rate_of(~fast).alias("conversion_8_hours_or_more"),
        referral.alias("dealer_referral_conversion_rate"),
        social.alias("social_media_conversion_rate"),
        ((referral - social) * 100).alias("dealer_referral_lift_pp_vs_social"),
        N.quotient(N.mean("quote_spread_pct", age > 9),
                   N.mean("quote_spread_pct", age.between(0, 2)))
        .alias("older_to_newer_relative_spread_ratio"),
        N.total("final_sale_price").alias("_accepted_value"))
    quotes = t["fact_quote"].agg(
        N.mean("quote_to_market_ratio", won).alias("accepted_quote_ratio"),
        N.mean("quote_to_market_ratio", ~won).alias("nonaccepted_quote_ratio"),
        N.mean("response_time_hours", won).alias("accepted_quote_response_hours"),
        N.mean("response_time_hours", ~won).alias("nonaccepted_quote_response_hours"))
    share = vehicle_segments(t, validate).agg(
        F.max(F.when(F.col("vehicle_type") == segment, F.col("accepted_value")))
        .alias("_segment_value"))
    dealers = cut(dealer_detail(t).withColumn("_share", N.ratio(
        F.col("wins").cast(N.COUNT), F.col("quotes")).cast("decimal(18,12)")))
    levels = exact_percentiles(dealers, [], "_share", 12, {
        "dealer_win_rate_p10": (1, 10), "dealer_win_rate_median": (1, 2),
        "dealer_win_rate_p90": (9, 10)})
    links = dealers.agg(
        F.corr("average_quote_to_market_ratio", "win_rate")
        .alias("dealer_competitiveness_win_correlation"),
        F.corr("average_response_hours", "win_rate").alias("dealer_response_win_correlation"))

    def extremes(df: DataFrame, lift: str, name: str) -> DataFrame:
        return df.agg(F.min(lift).alias(f"{name}_lift_pp_min_year"),
                      F.max(lift).alias(f"{name}_lift_pp_max_year"))

    wide = reduce(one_row, [
        quotes, share, levels, links,
        extremes(response_stability(t), "lift_percentage_points", "response"),
        extremes(channel_stability(t), "referral_lift_percentage_points", "referral"),
    ], inquiries)
    wide = wide.withColumn(f"{segment.lower()}_share_of_accepted_value", N.quotient(
        F.col("_segment_value"), F.col("_accepted_value"))).drop(
        "_segment_value", "_accepted_value")
    return unpivoted(wide)


def build_evidence(t: Tables, validate: str = "1:1", **options) -> dict[str, DataFrame]:
    """Every evidence table by name."""
    return {
        "metadata": metadata(t), "kpis": kpis(t), "evidence": evidence(t, validate, **options),
        "monthly": monthly(t), "annual": annual(t), "response_by_year": response_by_year(t),
        "response_stability": response_stability(t), "lead_source_by_year": channel_by_year(t),
        "lead_source_stability": channel_stability(t), "lead_sources": lead_sources(t),
        "response_bands": response_bands(t), "vehicle_age_bands": age_bands(t),
        "vehicle_segments": vehicle_segments(t, validate),
        "top_brands": brands(t, validate), "top_dealers": dealer_detail(t, 15),
        "dealer_detail": dealer_detail(t), "quality_metrics": t["data_quality_metrics"],
        "quality_issues": t["data_quality_issue_log"],
    }
