"""Workbook and notebook calculations as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions import numbers as N
from marketlens.functions import text as T
from marketlens.functions.calendar import date_spine
from marketlens.operators.joins import one_row
from marketlens.operators.order_stats import value_ranks
from marketlens.operators.profile import (
    correlations, field_profile, histogram, missing_shares, table_overview,
)
from marketlens.plans import evidence as E
from marketlens.plans.queries import ratio_fences
from marketlens.plans.views import Tables
from marketlens.schema import KEYS
from marketlens.session import cut

CORRELATED = ["conversion_flag", "fastest_response_hours", "quote_spread_pct", "quote_count",
              "vehicle_age_at_inquiry"]


def monthly_growth(t: Tables) -> DataFrame:
    """Monthly conversion with growth against the previous row."""
    before = F.lag("inquiries").over(Window.partitionBy(F.lit(0)).orderBy("month"))
    return E.monthly(t).select(
        "month", "inquiries", "conversions", "conversion_rate",
        (N.quotient(F.col("inquiries"), before) - 1).alias("month_over_month_growth"))


def lead_source_lift(t: Tables) -> DataFrame:
    """Rate, lift over the portfolio in percentage points and rank of each lead source."""
    sources = E.lead_sources(t).select("lead_source", "inquiries", "conversions",
                                       "conversion_rate")
    everything = sources.agg(N.quotient(F.sum("conversions"), F.sum("inquiries")).alias("_all"))
    # A lead source is one of a fixed vocabulary, so this window holds a handful of rows.
    place = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("conversion_rate")))
    return one_row(sources, everything).select(
        "lead_source", "inquiries", "conversions", "conversion_rate",
        ((F.col("conversion_rate") - F.col("_all")) * 100).alias("lift_pp"),
        place.cast("bigint").alias("rate_rank"))


def dealer_eligibility(t: Tables, min_quotes: int = 250) -> DataFrame:
    """Win rate of every dealer and the rank among those with enough quotes."""
    df = E.dealer_detail(t).select("dealer_id", "dealer_name", "quotes", "wins", "win_rate")
    eligible = F.col("quotes") >= min_quotes
    share = N.ratio(F.col("wins").cast(N.COUNT), F.col("quotes")) * F.lit(10 ** 15)
    df = cut(df.withColumns({"eligible": eligible,
                             "_score": F.when(eligible, share.cast("bigint"))}))
    return value_ranks(df, "_score", "eligible_rank", "rank", descending=True).drop("_score")


def quality_recomputed(t: Tables) -> DataFrame:
    """Quality rates recomputed from the stored counts, with readable names."""
    return t["data_quality_metrics"].select(
        "stage", "metric_name", T.prettify("metric_name").alias("metric"),
        "passed_records", "total_records",
        N.bounded_rate(F.col("passed_records"), F.col("total_records")).alias("rate"))


def curated_profile(t: Tables, approximate: bool = False) -> DataFrame:
    """Every field of the six curated tables."""
    return reduce(lambda a, b: a.unionByName(b),
                  [field_profile(t[name], name, approximate) for name in KEYS])


def headline_decisions(t: Tables, validate: str = "1:1") -> DataFrame:
    """The headline findings as text built from the evidence."""
    scalars = E.evidence(t, validate).unionByName(E.kpis(t))

    def value(name: str):
        return F.max(F.when(F.col("metric_name") == name, F.col("value")))

    row = scalars.agg(
        value("conversion_under_8_hours").alias("fast"),
        value("conversion_8_hours_or_more").alias("slow"),
        value("dealer_referral_lift_pp_vs_social").alias("lift"),
        value("older_to_newer_relative_spread_ratio").alias("spread"),
        value("quote_anomalies").alias("anomalies"))
    texts = {
        "Dealer response SLA": F.format_string(
            "<8h conversion %.2f%% vs %.2f%%", F.col("fast") * 100, F.col("slow") * 100),
        "Channel allocation": F.format_string(
            "Dealer Referral leads Social Media by %.2f pp", "lift"),
        "Older-vehicle pricing": F.format_string(
            "10+ year relative quote spread is %.2fx the 0-2 year spread", "spread"),
        "Pricing exceptions": F.concat(
            F.format_number("anomalies", 0), F.lit(" soft anomalies remain reviewable")),
    }
    entries = F.explode(F.array(*[
        F.struct(F.lit(k).alias("decision"), v.alias("finding")) for k, v in texts.items()]))
    return row.select(entries.alias("e")).select("e.*")


def overview(t: Tables) -> DataFrame:
    names = ["fact_inquiry", "fact_quote", "dim_vehicle", "dim_dealer"]
    return table_overview({name: (t[name], KEYS[name]) for name in names})


def missingness(t: Tables) -> DataFrame:
    return missing_shares(t["fact_inquiry"])


def value_histogram(t: Tables) -> DataFrame:
    return histogram(t["dim_vehicle"], "estimated_market_value", 2)


def ratio_histogram(t: Tables) -> DataFrame:
    return histogram(t["fact_quote"], "quote_to_market_ratio", 4)


def dealer_comparison(t: Tables) -> DataFrame:
    """Dealer statistics joined to names, best win rate first."""
    totals = t["fact_quote"].groupBy("dealer_id").agg(
        N.rows().alias("quotes"), N.count_where(F.col("accepted_flag")).alias("wins"),
        N.rate("accepted_flag").alias("win_rate"),
        N.mean("response_time_hours").alias("average_response_hours"),
        N.mean("quote_to_market_ratio").alias("quote_to_market_ratio"))
    return totals.join(t["dim_dealer"].select("dealer_id", "dealer_name", "dealer_region"),
                       "dealer_id", "left").orderBy(F.desc("win_rate"), "dealer_id")


def correlation_matrix(t: Tables) -> DataFrame:
    return correlations(t["fact_inquiry"], CORRELATED)


def outlier_rates(t: Tables) -> DataFrame:
    """How many quotes the business rule flags and how many lie outside the IQR fences."""
    ratio = F.col("quote_to_market_ratio")
    outside = ~F.coalesce(ratio.between(F.col("_low"), F.col("_high")), F.lit(False))
    wide = one_row(t["fact_quote"], ratio_fences(t["fact_quote"])).agg(
        N.rows().alias("_all"), N.count_where(F.col("anomaly_flag")).alias("_rule"),
        N.count_where(outside).alias("_iqr"))
    checks = {"Business-rule quote anomaly": "_rule", "IQR quote-ratio outlier": "_iqr"}
    entries = F.explode(F.array(*[
        F.struct(F.lit(k).alias("check"), F.col(c).alias("rows"),
                 N.quotient(F.col(c), F.col("_all")).alias("rate"))
        for k, c in checks.items()]))
    return wide.select(entries.alias("e")).select("e.*")


def fact_calendar(t: Tables) -> DataFrame:
    """Whole calendar years around the inquiry dates."""
    bounds = t["fact_inquiry"].agg(F.min("inquiry_date").alias("low"),
                                   F.max("inquiry_date").alias("high"))
    return date_spine(bounds, "low", "high")
