"""The 24 business queries. Volume guards are parameters, not constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions import numbers as N
from marketlens.functions.bands import band_below, band_upto
from marketlens.functions.calendar import month_of
from marketlens.operators.joins import one_row
from marketlens.operators.order_stats import (
    exact_percentiles, several_ranks, tile_summary, value_ranks,
)
from marketlens.plans.views import Tables, dealer_performance, quote_vehicle
from marketlens.schema import AGE_BANDS, RESPONSE_BANDS
from marketlens.session import cut



def _sold() -> Column:
    return F.col("conversion_flag")


def _sale_value() -> Column:
    return N.mean_up("final_sale_price", 2, _sold()).alias("average_sale_value")


def _accepted_value() -> Column:
    return F.sum(F.when(_sold(), F.col("final_sale_price"))).alias("accepted_value")


def _conversion() -> Column:
    return N.rate_up(_sold()).alias("conversion_rate")


def _by_month() -> Window:
    """Months are a calendar-bounded handful of rows once aggregated."""
    return Window.partitionBy(F.lit(0)).orderBy("month")


def _or_last(band: Column, bands: list) -> Column:
    """A missing value falls in the open last band, as the ELSE of a CASE would put it."""
    return F.coalesce(band, F.lit(bands[-1][1]))


def _monthly(t: Tables) -> DataFrame:
    return t["fact_inquiry"].groupBy(month_of("inquiry_date").alias("month")).agg(
        N.rows().alias("inquiries"), N.count_where(_sold()).alias("conversions"))


def _with_vehicle(t: Tables, facts: list[str], attributes: list[str]) -> DataFrame:
    return t["fact_inquiry"].select("vehicle_id", *facts).join(
        t["dim_vehicle"].select("vehicle_id", *attributes), "vehicle_id")


def q01(t: Tables) -> DataFrame:
    """Monthly inquiries and conversions."""
    return _monthly(t).withColumnRenamed("conversions", "converted_inquiries").orderBy("month")


def q02(t: Tables) -> DataFrame:
    """Monthly conversion rate with the trailing three-row rate."""
    trailing = _by_month().rowsBetween(-2, 0)
    return _monthly(t).select(
        "month", "inquiries", "conversions",
        N.ratio_up(F.col("conversions"), F.col("inquiries"), 4).alias("conversion_rate"),
        N.ratio_up(F.sum("conversions").over(trailing), F.sum("inquiries").over(trailing), 4)
        .alias("rolling_3m_conversion_rate")).orderBy("month")


def q03(t: Tables) -> DataFrame:
    """Average quote and accepted quote by quote month."""
    return t["fact_quote"].groupBy(month_of("quote_date").alias("month")).agg(
        N.mean_up("quote_amount", 2).alias("average_quote"),
        N.mean_up("quote_amount", 2, F.col("accepted_flag")).alias("average_accepted_quote"),
        N.rows().alias("quote_count")).orderBy("month")


def q04(t: Tables) -> DataFrame:
    """Average spread by vehicle type."""
    return _with_vehicle(t, ["quote_spread", "quote_spread_pct"], ["vehicle_type"]).groupBy(
        "vehicle_type").agg(
        N.rows().alias("inquiries"),
        N.mean_up("quote_spread", 2).alias("average_quote_spread_chf"),
        N.mean_up("quote_spread_pct", 2, factor=100).alias("average_quote_spread_percent")
    ).orderBy(F.desc_nulls_first("average_quote_spread_chf"))


def q05(t: Tables, min_quotes: int = 100) -> DataFrame:
    """Median and 90th percentile quote by brand."""
    quotes = quote_vehicle(t, ["quote_amount"], ["brand"])
    levels = exact_percentiles(quotes, ["brand"], "quote_amount", 2,
                               {"median_quote": (1, 2), "p90_quote": (9, 10)}, size="quotes")
    return levels.filter(F.col("quotes") >= min_quotes).select(
        "brand", "quotes", F.round("median_quote", 2).alias("median_quote"),
        F.round("p90_quote", 2).alias("p90_quote")).orderBy(F.desc_nulls_first("median_quote"))


def q06(t: Tables, min_quotes: int = 250, top: int = 20) -> DataFrame:
    """Leading dealers by win rate."""
    return dealer_performance(t).filter(F.col("total_quotes") >= min_quotes).select(
        "dealer_id", "dealer_name", "dealer_region", "total_quotes", "accepted_quotes",
        "dealer_win_rate", "average_response_time_hours", "average_quote_to_market_ratio",
        "accepted_quote_value").orderBy(
        F.desc_nulls_first("dealer_win_rate"), F.desc_nulls_first("accepted_quote_value"),
        "dealer_id").limit(top)


def q07(t: Tables, min_quotes: int = 250, top: int = 5) -> DataFrame:
    """Leading dealers inside each region; the rank filter prunes before the shuffle."""
    window = Window.partitionBy("dealer_region").orderBy(
        F.desc_nulls_first("dealer_win_rate"), F.desc_nulls_first("accepted_quote_value"))
    return (dealer_performance(t).filter(F.col("total_quotes") >= min_quotes)
            .withColumn("regional_rank", F.rank().over(window))
            .filter(F.col("regional_rank") <= top).orderBy("dealer_region", "regional_rank"))


def q08(t: Tables) -> DataFrame:
    """Conversion by fastest-response band."""
    band = _or_last(band_below(F.col("fastest_response_hours"), RESPONSE_BANDS), RESPONSE_BANDS)
    return t["fact_inquiry"].groupBy(band.alias("response_band")).agg(
        N.rows().alias("inquiries"), _conversion(), _sale_value(),
        F.min("fastest_response_hours").alias("_first")).orderBy("_first").drop("_first")


def q09(t: Tables) -> DataFrame:
    """Lead-source scorecard."""
    return t["fact_inquiry"].groupBy("lead_source").agg(
        N.rows().alias("inquiries"), N.count_where(_sold()).alias("conversions"),
        _conversion(), _sale_value(),
        N.mean_up("fastest_response_hours", 2).alias("average_fastest_response_hours")
    ).orderBy(F.desc_nulls_first("conversion_rate"))


def q10(t: Tables, min_inquiries: int = 500) -> DataFrame:
    """Conversion and value by brand."""
    return _with_vehicle(t, ["conversion_flag", "final_sale_price"],
                         ["brand", "estimated_market_value"]).groupBy("brand").agg(
        N.rows().alias("inquiries"), _conversion(),
        N.mean_up("estimated_market_value", 2).alias("average_market_value"),
        _accepted_value()).filter(F.col("inquiries") >= min_inquiries).orderBy(
        F.desc_nulls_first("accepted_value"))


def q11(t: Tables) -> DataFrame:
    """Conversion and spread by vehicle-age band; ages below zero fall in the first band."""
    band = _or_last(band_upto(F.col("vehicle_age_at_inquiry"), AGE_BANDS), AGE_BANDS)
    return t["fact_inquiry"].groupBy(band.alias("vehicle_age_band")).agg(
        N.rows().alias("inquiries"), _conversion(),
        N.mean_up("quote_spread", 2).alias("average_quote_spread"),
        N.mean_up("quote_spread_pct", 2, factor=100).alias("average_quote_spread_percent"),
        F.min("vehicle_age_at_inquiry").alias("_first")).orderBy("_first").drop("_first")


def q12(t: Tables) -> DataFrame:
    """Conversion by mileage bracket."""
    return _with_vehicle(t, ["conversion_flag", "quote_spread"],
                         ["mileage_bracket", "mileage_km"]).groupBy("mileage_bracket").agg(
        N.rows().alias("inquiries"), _conversion(),
        N.mean_up("quote_spread", 2).alias("average_quote_spread"),
        F.min("mileage_km").alias("_first")).orderBy("_first").drop("_first")


def q13(t: Tables, min_quotes: int = 250) -> DataFrame:
    """Dealer competitiveness without the flagged anomalies."""
    totals = t["fact_quote"].filter(~F.col("anomaly_flag")).groupBy("dealer_id").agg(
        N.rows().alias("valid_quotes"),
        N.mean_up("quote_to_market_ratio", 4).alias("average_quote_to_market_ratio"),
        N.mean_up("response_time_hours", 2).alias("average_response_hours"),
        N.rate_up("accepted_flag").alias("quote_win_rate")).filter(
        F.col("valid_quotes") >= min_quotes)
    return (t["dim_dealer"].select("dealer_id", "dealer_name").join(totals, "dealer_id")
            .orderBy(F.desc_nulls_first("average_quote_to_market_ratio"),
                     F.desc_nulls_first("quote_win_rate")))


def q14(t: Tables, min_inquiries: int = 100) -> DataFrame:
    """Opportunity matrix by vehicle type and fuel."""
    return _with_vehicle(t, ["conversion_flag", "final_sale_price"],
                         ["vehicle_type", "fuel_type", "estimated_market_value"]).groupBy(
        "vehicle_type", "fuel_type").agg(
        N.rows().alias("inquiries"), _conversion(),
        N.mean_up("estimated_market_value", 2).alias("average_market_value"),
        _accepted_value()).filter(F.col("inquiries") >= min_inquiries).orderBy(
        F.desc_nulls_first("accepted_value"))


def q15(t: Tables) -> DataFrame:
    """Dealer-region performance; quotes collapse to dealers before they meet the regions."""
    won = F.col("accepted_flag")
    per_dealer = t["fact_quote"].groupBy("dealer_id").agg(
        F.count("quote_id").alias("_quotes"), N.count_where(won).alias("_wins"),
        F.count("accepted_flag").alias("_flags"),
        F.sum("response_time_hours").alias("_hours"),
        F.count("response_time_hours").alias("_timed"),
        F.sum(F.when(won, F.col("quote_amount"))).alias("_value"))
    return (t["dim_dealer"].select("dealer_id", "dealer_region").join(per_dealer, "dealer_id")
            .groupBy("dealer_region").agg(
                F.sum("_quotes").alias("quotes"), F.sum("_wins").alias("wins"),
                N.ratio_up(F.sum("_wins"), F.sum("_flags"), 4).alias("quote_win_rate"),
                F.round(N.ratio(F.sum("_hours"), F.sum("_timed")), 2)
                .alias("average_response_hours"),
                F.sum("_value").alias("accepted_value"))
            .orderBy(F.desc_nulls_first("accepted_value")))


def q16(t: Tables) -> DataFrame:
    """Month-over-month growth by the previous row."""
    before = F.lag("inquiries").over(_by_month())
    return _monthly(t).select(
        "month", "inquiries", before.alias("previous_month_inquiries")).withColumn(
        "month_over_month_growth",
        N.ratio_up(F.col("inquiries") - F.col("previous_month_inquiries"),
                   F.col("previous_month_inquiries"), 4)).orderBy("month")


def q17(t: Tables) -> DataFrame:
    """Year-over-year growth by the twelfth row before."""
    window = _by_month()
    df = _monthly(t).withColumns({
        "_inquiries": F.lag("inquiries", 12).over(window),
        "_conversions": F.lag("conversions", 12).over(window)})

    def growth(name: str) -> Column:
        return N.ratio_up(F.col(name) - F.col(f"_{name}"), F.col(f"_{name}"), 4)

    return df.select(
        "month", "inquiries", growth("inquiries").alias("inquiry_yoy_growth"), "conversions",
        growth("conversions").alias("conversion_yoy_growth")).orderBy("month")


def q18(t: Tables, min_quotes: int = 250) -> DataFrame:
    """Composite dealer rank: half win rate, a quarter each speed and competitiveness.

    Percent ranks are whole positions over (dealers - 1), so the score is kept as a whole
    number until it is shown and equal scores tie exactly. No step sorts all dealers at once.
    """
    df = cut(dealer_performance(t).filter(F.col("total_quotes") >= min_quotes))
    ranks = several_ranks(df, "dealer_id", {
        "_win": F.col("dealer_win_rate") * 10_000,
        "_hours": F.col("average_response_time_hours") * 100,
        "_market": F.col("average_quote_to_market_ratio") * 10_000})
    last = F.col("_dealers") - 1
    # One minus the percent rank is one for a single dealer, when all percent ranks are zero.
    speed = F.when(last == 0, F.lit(1)).otherwise(last - (F.col("_hours") - 1))
    points = (F.col("_win") - 1) * 2 + speed + (F.col("_market") - 1)
    scored = one_row(df.join(ranks, "dealer_id"), df.agg(N.rows().alias("_dealers")))
    scored = cut(scored.withColumn("_points", points.cast("bigint")))
    return value_ranks(scored, "_points", "dealer_rank", descending=True).select(
        "dealer_id", "dealer_name", "dealer_region", "total_quotes", "dealer_win_rate",
        "average_response_time_hours", "average_quote_to_market_ratio",
        N.ratio_up(F.col("_points"), F.greatest(last, F.lit(1)) * 4, 4).alias("composite_score"),
        "dealer_rank").orderBy("dealer_rank")


def ratio_fences(quotes: DataFrame) -> DataFrame:
    """One row with the lower and upper 1.5-IQR fence of the quote-to-market ratio."""
    quartiles = exact_percentiles(quotes, [], "quote_to_market_ratio", 4,
                                  {"q1": (1, 4), "q3": (3, 4)})
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)")
    return quartiles.select((F.col("q1") - reach).alias("_low"),
                            (F.col("q3") + reach).alias("_high"))


def q19(t: Tables) -> DataFrame:
    """Quotes outside the IQR fences or the business range, with the reason."""
    ratio = F.col("quote_to_market_ratio")
    reason = (F.when(ratio < F.col("_low"), "IQR low outlier")
              .when(ratio > F.col("_high"), "IQR high outlier")
              .when(F.col("anomaly_flag"), "Business-rule anomaly"))
    return (one_row(t["fact_quote"], ratio_fences(t["fact_quote"]))
            .withColumn("anomaly_reason", reason).filter("anomaly_reason is not null")
            .select("quote_id", "inquiry_id", "dealer_id", "quote_amount",
                    "estimated_market_value", "quote_to_market_ratio", "anomaly_flag",
                    "anomaly_reason")
            .orderBy(F.desc_nulls_first(F.abs(ratio - 1))))


def q20(t: Tables) -> DataFrame:
    """Quality scores before and after cleaning with the gain in percentage points."""
    order = F.when(F.col("stage") == "Raw", 1).when(F.col("stage") == "Processed", 2)
    exact = F.col("rate").cast("decimal(20,18)")
    before = F.lag(exact).over(Window.partitionBy("metric_name").orderBy(order))
    return t["data_quality_metrics"].select(
        "stage", "metric_name", "passed_records", "total_records",
        F.round(exact * 100, 2).alias("rate_percent"),
        F.round((exact - before) * 100, 2).alias("improvement_percentage_points"),
        order.alias("_order")).orderBy("metric_name", "_order").drop("_order")


def q21(t: Tables, min_inquiries: int = 100) -> DataFrame:
    """Spread by single year of vehicle age."""
    inquiries = t["fact_inquiry"]
    sizes = inquiries.groupBy("vehicle_age_at_inquiry").agg(
        N.rows().alias("inquiries"), N.mean_up("quote_spread", 2).alias("average_spread"),
        N.mean_up("quote_spread_pct", 2, factor=100).alias("average_spread_percent")).filter(
        F.col("inquiries") >= min_inquiries)
    middle = exact_percentiles(inquiries, ["vehicle_age_at_inquiry"], "quote_spread", 2,
                               {"median_spread": (1, 2)})
    return sizes.join(middle, "vehicle_age_at_inquiry").select(
        "vehicle_age_at_inquiry", "inquiries", "average_spread",
        F.round("median_spread", 2).alias("median_spread"), "average_spread_percent"
    ).orderBy("vehicle_age_at_inquiry")


def q22(t: Tables) -> DataFrame:
    """Lead-source quality index against the whole portfolio."""
    def sums(prefix: str) -> list[Column]:
        return [N.rows().alias(f"{prefix}n"), N.count_where(_sold()).alias(f"{prefix}sold"),
                F.sum(F.when(_sold(), F.col("final_sale_price"))).alias(f"{prefix}value"),
                F.count(F.when(_sold(), F.col("final_sale_price"))).alias(f"{prefix}priced")]

    sources = t["fact_inquiry"].groupBy("lead_source").agg(*sums("_"))
    portfolio = t["fact_inquiry"].agg(*sums("_all_"))
    rate = N.ratio(F.col("_sold").cast(N.COUNT), F.col("_n"))
    value = N.ratio(F.col("_value"), F.col("_priced"))
    index = (N.quotient(F.col("_sold"), F.col("_n"))
             / N.quotient(F.col("_all_sold"), F.col("_all_n"))
             * (N.quotient(F.col("_value"), F.col("_priced"))
                / N.quotient(F.col("_all_value"), F.col("_all_priced"))))
    return one_row(sources, portfolio).select(
        "lead_source", F.col("_n").alias("inquiries"), F.round(rate, 4).alias("conversion_rate"),
        F.round(value, 2).alias("average_sale_value"),
        F.round(index, 4).alias("quality_index")).orderBy(F.desc_nulls_first("quality_index"))


def q23(t: Tables) -> DataFrame:
    """Conversion by response-time quartile."""
    return tile_summary(t["fact_inquiry"], 4, "fastest_response_hours", 2, "conversion_flag",
                        "response_quartile").select(
        "response_quartile", F.col("rows").alias("inquiries"),
        F.round("lowest", 2).alias("min_hours"), F.round("highest", 2).alias("max_hours"),
        N.ratio_up(F.col("flagged"), F.col("rows"), 4).alias("conversion_rate")
    ).orderBy("response_quartile")


def q24(t: Tables, min_inquiries: int = 250, top: int = 3) -> DataFrame:
    """Leading models of each brand by accepted value."""
    models = _with_vehicle(t, ["conversion_flag", "final_sale_price"],
                           ["brand", "model", "estimated_market_value"]).groupBy(
        "brand", "model").agg(
        N.rows().alias("inquiries"),
        N.mean_up("estimated_market_value", 2).alias("average_market_value"),
        _conversion(), _accepted_value()).filter(F.col("inquiries") >= min_inquiries)
    window = Window.partitionBy("brand").orderBy(F.desc_nulls_first("accepted_value"), "model")
    return (models.withColumn("model_rank", F.row_number().over(window))
            .filter(F.col("model_rank") <= top).orderBy(F.desc_nulls_first("accepted_value")))


QUERIES = {f"q{n:02d}": globals()[f"q{n:02d}"] for n in range(1, 25)}
