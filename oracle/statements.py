"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.base import (
    DEALER_PERFORMANCE, div_up, mean, mean_up, percentile_units, rate, rate_up, total, units,
    with_base,
)
from oracle.operations import operations

SOLD, WON = "conversion_flag", "accepted_flag"
MONTH = "CAST(date_trunc('month', inquiry_date) AS DATE)"
INQ_VEH = "fact_inquiry i JOIN dim_vehicle v USING (vehicle_id)"
RESPONSE = ("CASE WHEN fastest_c < 400 THEN '<4 hours' WHEN fastest_c < 800 THEN '4-8 hours' "
            "WHEN fastest_c < 1600 THEN '8-16 hours' WHEN fastest_c < 2400 THEN '16-24 hours' "
            "ELSE '24+ hours' END")
AGE = ("CASE WHEN vehicle_age_at_inquiry <= 2 THEN '0-2 years' WHEN vehicle_age_at_inquiry <= 5 "
       "THEN '3-5 years' WHEN vehicle_age_at_inquiry <= 9 THEN '6-9 years' "
       "ELSE '10+ years' END")
REPORT_BAND = ("CASE WHEN fastest_c < 200 THEN 'Under 2 hours' WHEN fastest_c < 400 THEN "
               "'2-4 hours' WHEN fastest_c < 800 THEN '4-8 hours' WHEN fastest_c < 1200 THEN "
               "'8-12 hours' ELSE '12+ hours' END")
REPORT_ORDER = ("CASE WHEN fastest_c < 200 THEN 1 WHEN fastest_c < 400 THEN 2 "
                "WHEN fastest_c < 800 THEN 3 WHEN fastest_c < 1200 THEN 4 ELSE 5 END")
SALE = f"{mean_up('price_c', 2, 2, SOLD)} AS average_sale_value"
CONV = f"{rate_up(SOLD)} AS conversion_rate"
VALUE = f"{total('price_c', 2, SOLD)} AS accepted_value"
SPREAD = f"{mean_up('spread_c', 2, 2)}"
SPREAD_PCT = f"{mean_up('pct_u', 4, 2, factor=100)}"
HOURS = f"{mean_up('fastest_c', 2, 2)}"
MONTHLY = f"""monthly AS (SELECT {MONTH} AS month, count(*) AS inquiries,
  count(*) FILTER (WHERE {SOLD}) AS conversions FROM fact_inquiry GROUP BY 1)"""
INQUIRY_COLUMNS = f"""i.inquiry_id, i.inquiry_date, {units('i.price_c', 2)} AS final_sale_price,
  i.days_to_conversion, i.quote_count, {units('i.high_c', 2)} AS highest_quote,
  {units('i.low_c', 2)} AS lowest_quote, {units('i.avg_c', 2)} AS average_quote,
  {units('i.spread_c', 2)} AS quote_spread, {units('i.pct_u', 4)} AS quote_spread_pct,
  {units('i.fastest_c', 2)} AS fastest_response_hours, i.vehicle_age_at_inquiry, i.lead_source,
  i.status, i.conversion_flag, i.winning_dealer_id"""
QUOTE_COLUMNS = f"""q.quote_id, q.inquiry_id, q.dealer_id, q.quote_date,
  {units('q.amount_c', 2)} AS quote_amount, {units('q.hours_c', 2)} AS response_time_hours,
  q.quote_rank, q.accepted_flag, {units('q.value_c', 2)} AS estimated_market_value,
  {units('q.ratio_u', 4)} AS quote_to_market_ratio, q.anomaly_flag"""


def curated() -> dict[str, str]:
    return {
        "clean_dim_customer": "SELECT * FROM dim_customer",
        "clean_dim_vehicle": f"""SELECT vehicle_id, brand, model, vehicle_type, fuel_type,
            manufacture_year, mileage_km, {units('value_c', 2)} AS estimated_market_value,
            vehicle_condition, mileage_bracket, market_value_band FROM dim_vehicle""",
        "clean_dim_dealer": f"""SELECT dealer_id, dealer_name, dealer_region, dealer_type,
            {units('rating_c', 2)} AS dealer_rating, active_flag FROM dim_dealer""",
        "clean_dim_date": """SELECT date, year(date) AS year, 'Q' || quarter(date) AS quarter,
            month(date) AS month, monthname(date) AS month_name, week(date) AS week,
            dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend FROM dim_date""",
        "clean_fact_inquiry": f"SELECT {INQUIRY_COLUMNS}, customer_id, vehicle_id "
                              "FROM fact_inquiry i",
        "clean_fact_quote": f"SELECT {QUOTE_COLUMNS} FROM fact_quote q",
        "x13_fact_calendar": """SELECT CAST(unnest(generate_series(
            make_date(year(min(inquiry_date)), 1, 1), make_date(year(max(inquiry_date)), 12, 31),
            INTERVAL 1 DAY)) AS DATE) AS date FROM fact_inquiry""",
    }


def views() -> dict[str, str]:
    return {
        "v1_inquiry_analytics": f"""SELECT {INQUIRY_COLUMNS}, {MONTH} AS inquiry_month,
            customer_type, age_group, canton, preferred_contact_method, brand, model,
            vehicle_type, fuel_type, mileage_km, mileage_bracket,
            {units('v.value_c', 2)} AS estimated_market_value, vehicle_condition
            FROM {INQ_VEH} JOIN dim_customer c USING (customer_id)""",
        "v2_quote_competitiveness": f"""SELECT {QUOTE_COLUMNS}, dealer_name, dealer_region,
            brand, model, vehicle_type FROM fact_quote q JOIN dim_dealer d USING (dealer_id)
            JOIN fact_inquiry i USING (inquiry_id) JOIN dim_vehicle v USING (vehicle_id)""",
        "v3_dealer_performance": "SELECT * FROM vw_dealer",
        "v4_monthly_commercial_performance": f"""SELECT {MONTH} AS month,
            count(*) AS total_inquiries, count(*) FILTER (WHERE {SOLD}) AS converted_inquiries,
            {CONV}, {SALE}, {SPREAD} AS average_quote_spread,
            {HOURS} AS average_fastest_response_hours FROM fact_inquiry GROUP BY 1""",
    }


def business(g: dict) -> dict[str, str]:
    def low(name: str) -> int:
        return next(iter(g[name].values()))

    levels = percentile_units("(SELECT brand, amount_c FROM fact_quote JOIN fact_inquiry USING "
                              "(inquiry_id) JOIN dim_vehicle USING (vehicle_id))", ["brand"],
                              "amount_c", {"median": (1, 2), "p90": (9, 10)})
    ages = percentile_units("fact_inquiry", ["vehicle_age_at_inquiry"], "spread_c",
                            {"median": (1, 2)})
    fences = percentile_units("fact_quote", [], "ratio_u", {"q1": (1, 4), "q3": (3, 4)})
    growth = {c: div_up(f"({c} - {p})", p, 4) for c, p in (
        ("inquiries", "previous"), ("conversions", "prior_conversions"))}
    trailing = "OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    dealer_columns = ("dealer_id, dealer_name, dealer_region, total_quotes, accepted_quotes, "
                      "dealer_win_rate, average_response_time_hours, "
                      "average_quote_to_market_ratio, accepted_quote_value")
    return {
        "q01": f"SELECT {MONTH} AS month, count(*) AS inquiries, count(*) FILTER "
               f"(WHERE {SOLD}) AS converted_inquiries FROM fact_inquiry GROUP BY 1",
        "q02": f"""SELECT *, {div_up('conversions', 'inquiries', 4)} AS conversion_rate,
            {div_up(f'(sum(conversions) {trailing})', f'(sum(inquiries) {trailing})', 4)}
            AS rolling_3m_conversion_rate FROM monthly""",
        "q03": f"""SELECT CAST(date_trunc('month', quote_date) AS DATE) AS month,
            {mean_up('amount_c', 2, 2)} AS average_quote,
            {mean_up('amount_c', 2, 2, WON)} AS average_accepted_quote,
            count(*) AS quote_count FROM fact_quote GROUP BY 1""",
        "q04": f"""SELECT vehicle_type, count(*) AS inquiries,
            {SPREAD} AS average_quote_spread_chf, {SPREAD_PCT} AS average_quote_spread_percent
            FROM {INQ_VEH} GROUP BY 1""",
        "q05": f"""SELECT brand, n AS quotes,
            {div_up('median_t', '(median_b * 100)', 2)} AS median_quote,
            {div_up('p90_t', '(p90_b * 100)', 2)} AS p90_quote
            FROM ({levels}) WHERE n >= {low('q05')}""",
        "q06": f"""SELECT {dealer_columns} FROM vw_dealer WHERE total_quotes >= {low('q06')}
            ORDER BY dealer_win_rate DESC, accepted_quote_value DESC, dealer_id LIMIT 20""",
        "q07": f"""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY dealer_region ORDER BY
            dealer_win_rate DESC NULLS FIRST, accepted_quote_value DESC NULLS FIRST)
            AS regional_rank FROM vw_dealer WHERE total_quotes >= {low('q07')})
            WHERE regional_rank <= 5""",
        "q08": f"SELECT {RESPONSE} AS response_band, count(*) AS inquiries, {CONV}, {SALE} "
               "FROM fact_inquiry GROUP BY 1",
        "q09": f"""SELECT lead_source, count(*) AS inquiries, count(*) FILTER (WHERE {SOLD})
            AS conversions, {CONV}, {SALE}, {HOURS} AS average_fastest_response_hours
            FROM fact_inquiry GROUP BY 1""",
        "q10": f"""SELECT brand, count(*) AS inquiries, {CONV},
            {mean_up('v.value_c', 2, 2)} AS average_market_value, {VALUE}
            FROM {INQ_VEH} GROUP BY 1 HAVING count(*) >= {low('q10')}""",
        "q11": f"""SELECT {AGE} AS vehicle_age_band, count(*) AS inquiries, {CONV},
            {SPREAD} AS average_quote_spread, {SPREAD_PCT} AS average_quote_spread_percent
            FROM fact_inquiry GROUP BY 1""",
        "q12": f"""SELECT mileage_bracket, count(*) AS inquiries, {CONV},
            {SPREAD} AS average_quote_spread FROM {INQ_VEH} GROUP BY 1""",
        "q13": f"""SELECT dealer_id, dealer_name, count(*) AS valid_quotes,
            {mean_up('ratio_u', 4, 4)} AS average_quote_to_market_ratio,
            {mean_up('hours_c', 2, 2)} AS average_response_hours,
            {rate_up(WON)} AS quote_win_rate
            FROM fact_quote JOIN dim_dealer USING (dealer_id) WHERE NOT anomaly_flag
            GROUP BY 1, 2 HAVING count(*) >= {low('q13')}""",
        "q14": f"""SELECT vehicle_type, fuel_type, count(*) AS inquiries, {CONV},
            {mean_up('v.value_c', 2, 2)} AS average_market_value, {VALUE}
            FROM {INQ_VEH} GROUP BY 1, 2 HAVING count(*) >= {low('q14')}""",
        "q15": f"""SELECT dealer_region, count(quote_id) AS quotes,
            count(quote_id) FILTER (WHERE {WON}) AS wins, {rate_up(WON)} AS quote_win_rate,
            {mean_up('hours_c', 2, 2)} AS average_response_hours,
            {total('amount_c', 2, WON)} AS accepted_value
            FROM fact_quote JOIN dim_dealer USING (dealer_id) GROUP BY 1""",
        "q16": f"""SELECT month, inquiries, previous AS previous_month_inquiries,
            {growth['inquiries']} AS month_over_month_growth
            FROM (SELECT *, lag(inquiries) OVER (ORDER BY month) AS previous FROM monthly)""",
        "q17": f"""SELECT month, inquiries, {growth['inquiries']} AS inquiry_yoy_growth,
            conversions, {growth['conversions']} AS conversion_yoy_growth
            FROM (SELECT *, lag(inquiries, 12) OVER (ORDER BY month) AS previous,
              lag(conversions, 12) OVER (ORDER BY month) AS prior_conversions FROM monthly)""",
        "q18": f"""SELECT dealer_id, dealer_name, dealer_region, total_quotes, dealer_win_rate,
            average_response_time_hours, average_quote_to_market_ratio,
            {div_up('p', '(4 * greatest(n - 1, 1))', 4)} AS composite_score,
            rank() OVER (ORDER BY p DESC) AS dealer_rank
            FROM (SELECT *, 2 * (w - 1) + CASE WHEN n = 1 THEN 1 ELSE n - h END + (m - 1) AS p
              FROM (SELECT *, count(*) OVER () AS n,
                rank() OVER (ORDER BY dealer_win_rate) AS w,
                rank() OVER (ORDER BY average_response_time_hours) AS h,
                rank() OVER (ORDER BY average_quote_to_market_ratio) AS m
              FROM vw_dealer WHERE total_quotes >= {low('q18')}))""",
        # Fences in eighths of a unit: quartiles are quarters, 1.5 times adds a half.
        "q19": f"""SELECT * FROM (SELECT quote_id, inquiry_id, dealer_id,
            {units('amount_c', 2)} AS quote_amount,
            {units('value_c', 2)} AS estimated_market_value,
            {units('ratio_u', 4)} AS quote_to_market_ratio, anomaly_flag,
            CASE WHEN 8 * ratio_u < 2 * q1_t - 3 * (q3_t - q1_t) THEN 'IQR low outlier'
              WHEN 8 * ratio_u > 2 * q3_t + 3 * (q3_t - q1_t) THEN 'IQR high outlier'
              WHEN anomaly_flag THEN 'Business-rule anomaly' END AS anomaly_reason
            FROM fact_quote, ({fences})) WHERE anomaly_reason IS NOT NULL""",
        "q21": f"""SELECT vehicle_age_at_inquiry, inquiries, average_spread,
            {div_up('median_t', '(median_b * 100)', 2)} AS median_spread,
            average_spread_percent
            FROM (SELECT vehicle_age_at_inquiry, count(*) AS inquiries,
              {SPREAD} AS average_spread, {SPREAD_PCT} AS average_spread_percent
              FROM fact_inquiry GROUP BY 1) JOIN ({ages}) USING (vehicle_age_at_inquiry)
            WHERE inquiries >= {low('q21')}""",
        "q22": f"""SELECT s.lead_source, s.n AS inquiries,
            {div_up('s.sold', 's.n', 4)} AS conversion_rate,
            {div_up('s.value', '(s.priced * 100)', 2)} AS average_sale_value,
            round((CAST(s.sold AS DOUBLE) / s.n) / (CAST(p.sold AS DOUBLE) / p.n)
              * ((CAST(s.value AS DOUBLE) / 100 / s.priced)
                 / (CAST(p.value AS DOUBLE) / 100 / p.priced)), 4) AS quality_index
            FROM (SELECT lead_source, count(*) AS n, count(*) FILTER (WHERE {SOLD}) AS sold,
              sum(price_c) AS value, count(price_c) AS priced FROM fact_inquiry GROUP BY 1) s,
              (SELECT count(*) AS n, count(*) FILTER (WHERE {SOLD}) AS sold,
              sum(price_c) AS value, count(price_c) AS priced FROM fact_inquiry) p""",
        "q23": f"""SELECT response_quartile, count(*) AS inquiries,
            {units('min(fastest_c)', 2)} AS min_hours, {units('max(fastest_c)', 2)} AS max_hours,
            {CONV} FROM (SELECT *, ntile(4) OVER (ORDER BY fastest_c, conversion_flag)
              AS response_quartile FROM fact_inquiry) GROUP BY 1""",
        "q24": f"""SELECT brand, model, inquiries, average_market_value, conversion_rate,
            accepted_value, model_rank FROM (SELECT *, row_number() OVER (PARTITION BY brand
              ORDER BY accepted_value DESC NULLS FIRST, model) AS model_rank
              FROM (SELECT brand, model, count(*) AS inquiries,
                {mean_up('v.value_c', 2, 2)} AS average_market_value, {CONV}, {VALUE}
                FROM {INQ_VEH} GROUP BY 1, 2 HAVING count(*) >= {low('q24')}))
            WHERE model_rank <= 3""",
    }


def audits() -> dict[str, str]:
    keys = {"dim_customer": "customer_id", "dim_vehicle": "vehicle_id",
            "dim_dealer": "dealer_id", "fact_inquiry": "inquiry_id", "fact_quote": "quote_id"}
    return {
        "d01": " UNION ALL ".join(
            f"SELECT '{t}.{k}' AS rule, count(*) - count(DISTINCT {k}) AS failures FROM {t}"
            for t, k in keys.items()),
        "d02": "SELECT count(*) AS invalid_mileage_rows FROM dim_vehicle "
               "WHERE mileage_km NOT BETWEEN 0 AND 500000 OR mileage_km IS NULL",
        "d03": "SELECT count(*) AS invalid_quote_amount_rows FROM fact_quote "
               "WHERE amount_c <= 0 OR amount_c > 50000000 OR amount_c IS NULL",
        "d04": """SELECT count(*) FILTER (WHERE c.customer_id IS NULL) AS orphan_customers,
            count(*) FILTER (WHERE v.vehicle_id IS NULL) AS orphan_vehicles FROM fact_inquiry i
            LEFT JOIN dim_customer c ON c.customer_id = i.customer_id
            LEFT JOIN dim_vehicle v ON v.vehicle_id = i.vehicle_id""",
        "d05": """SELECT count(*) FILTER (WHERE i.inquiry_id IS NULL) AS orphan_inquiries,
            count(*) FILTER (WHERE d.dealer_id IS NULL) AS orphan_dealers FROM fact_quote q
            LEFT JOIN fact_inquiry i ON i.inquiry_id = q.inquiry_id
            LEFT JOIN dim_dealer d ON d.dealer_id = q.dealer_id""",
        "d06": """SELECT count(*) AS quote_before_inquiry_rows FROM fact_quote q
            JOIN fact_inquiry i USING (inquiry_id) WHERE q.quote_date < i.inquiry_date""",
        "d07": f"""SELECT count(*) AS invalid_accepted_quote_rules FROM fact_inquiry i JOIN
            (SELECT inquiry_id, count(*) FILTER (WHERE {WON}) AS n FROM fact_quote GROUP BY 1) a
            USING (inquiry_id) WHERE (conversion_flag AND n <> 1)
            OR (NOT conversion_flag AND n <> 0)""",
        "d08": f"""SELECT count(*) AS winning_dealer_mismatches FROM fact_inquiry i
            JOIN fact_quote q ON q.inquiry_id = i.inquiry_id AND q.{WON}
            WHERE i.winning_dealer_id IS DISTINCT FROM q.dealer_id""",
        "d09": """SELECT count(*) AS metric_discrepancies FROM fact_inquiry i JOIN
            (SELECT inquiry_id, count(*) AS n, max(amount_c) AS h, min(amount_c) AS l
             FROM fact_quote GROUP BY 1) r USING (inquiry_id)
            WHERE quote_count <> n OR high_c <> h OR low_c <> l OR spread_c <> h - l""",
    }


def by_year(flag_text: str, group: str, where: str = "TRUE") -> str:
    return (f"SELECT year(inquiry_date) AS year, {flag_text} AS {group}, count(*) AS inquiries, "
            f"count(*) FILTER (WHERE {SOLD}) AS conversions, {rate(SOLD)} AS conversion_rate "
            f"FROM fact_inquiry WHERE {where} GROUP BY 1, 2")


FAST = "CASE WHEN fastest_c < 800 THEN 'Under 8 hours' ELSE '8+ hours' END"
RESPONSE_YEAR = by_year(FAST, "response_group")
CHANNEL_YEAR = by_year("lead_source", "lead_source",
                       "lead_source IN ('Dealer Referral', 'Social Media')")
RESPONSE_STABILITY = f"""SELECT *, ("Under 8 hours" - "8+ hours") * 100
  AS lift_percentage_points FROM (SELECT year,
    max(conversion_rate) FILTER (WHERE response_group = 'Under 8 hours') AS "Under 8 hours",
    max(conversion_rate) FILTER (WHERE response_group = '8+ hours') AS "8+ hours"
  FROM ({RESPONSE_YEAR}) GROUP BY year)"""
CHANNEL_STABILITY = f"""SELECT *, ("Dealer Referral" - "Social Media") * 100
  AS referral_lift_percentage_points FROM (SELECT year,
    max(conversion_rate) FILTER (WHERE lead_source = 'Dealer Referral') AS "Dealer Referral",
    max(conversion_rate) FILTER (WHERE lead_source = 'Social Media') AS "Social Media"
  FROM ({CHANNEL_YEAR}) GROUP BY year)"""
DEALER_DETAIL = f"""SELECT dealer_id, dealer_name, dealer_region, count(*) AS quotes,
  count(*) FILTER (WHERE {WON}) AS wins, {rate(WON)} AS win_rate,
  {mean('hours_c', 2)} AS average_response_hours,
  {mean('ratio_u', 4)} AS average_quote_to_market_ratio,
  {total('amount_c', 2, WON, zero=True)} AS accepted_value
  FROM fact_quote JOIN dim_dealer USING (dealer_id) GROUP BY 1, 2, 3"""
LEADS = f"""SELECT lead_source, count(*) AS inquiries, count(*) FILTER (WHERE {SOLD})
  AS conversions, {rate(SOLD)} AS conversion_rate, {mean('price_c', 2)} AS average_sale_value,
  {mean('fastest_c', 2)} AS fastest_response_hours
  FROM fact_inquiry WHERE lead_source IS NOT NULL GROUP BY 1"""


def _spine(name: str, labels: list[str], found: str) -> str:
    rows = ", ".join(f"('{label}')" for label in labels)
    return f"SELECT s.{name}, f.* EXCLUDE ({name}) FROM (VALUES {rows}) AS s({name}) " \
           f"LEFT JOIN ({found}) f ON f.{name} = s.{name}"


def _scalars(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric_name, round(CAST(({query}) AS DOUBLE), 8) AS value"
        for name, query in parts.items())


def evidence() -> dict[str, str]:
    z = 1.959963984540054
    z2 = z * z
    middle = f"((share + {z2!r} / (n * 2)) / ({z2!r} / n + 1))"
    margin = (f"(sqrt(share * (1 - share) / n + {z2!r} / (n * n * 4)) * {z!r} "
              f"/ ({z2!r} / n + 1))")

    def inq(x: str) -> str:
        return f"SELECT {x} FROM fact_inquiry"

    def quo(x: str) -> str:
        return f"SELECT {x} FROM fact_quote"

    def rate_of(where: str) -> str:
        return (f"CAST(count(*) FILTER (WHERE {SOLD} AND {where}) AS DOUBLE) "
                f"/ count(*) FILTER (WHERE {where})")

    def pct(top: int, bottom: int) -> str:
        return f"SELECT quantile_cont(win_rate, {top / bottom}) FROM ({DEALER_DETAIL})"

    source = "lead_source = '{}'".format
    scalars = {
        "inquiry_growth_1995_to_2000": inq(
            "CAST(count(*) FILTER (WHERE year(inquiry_date) = 2000) AS DOUBLE) "
            "/ count(*) FILTER (WHERE year(inquiry_date) = 1995) - 1"),
        "conversion_under_8_hours": inq(rate_of("fastest_c < 800")),
        "conversion_8_hours_or_more": inq(rate_of("fastest_c >= 800")),
        "dealer_referral_conversion_rate": inq(rate_of(source("Dealer Referral"))),
        "social_media_conversion_rate": inq(rate_of(source("Social Media"))),
        "dealer_referral_lift_pp_vs_social": inq(
            f"({rate_of(source('Dealer Referral'))} - {rate_of(source('Social Media'))}) * 100"),
        "accepted_quote_ratio": quo(mean("ratio_u", 4, WON)),
        "nonaccepted_quote_ratio": quo(mean("ratio_u", 4, f"NOT {WON}")),
        "accepted_quote_response_hours": quo(mean("hours_c", 2, WON)),
        "nonaccepted_quote_response_hours": quo(mean("hours_c", 2, f"NOT {WON}")),
        "older_to_newer_relative_spread_ratio": inq(
            f"{mean('pct_u', 4, 'vehicle_age_at_inquiry > 9')} "
            f"/ {mean('pct_u', 4, 'vehicle_age_at_inquiry BETWEEN 0 AND 2')}"),
        "economy_share_of_accepted_value":
            "SELECT CAST(sum(price_c) FILTER (WHERE vehicle_type = 'Economy') AS DOUBLE) "
            f"/ sum(price_c) FROM {INQ_VEH}",
        "dealer_win_rate_p10": pct(1, 10), "dealer_win_rate_median": pct(1, 2),
        "dealer_win_rate_p90": pct(9, 10),
        "dealer_competitiveness_win_correlation":
            f"SELECT corr(average_quote_to_market_ratio, win_rate) FROM ({DEALER_DETAIL})",
        "dealer_response_win_correlation":
            f"SELECT corr(average_response_hours, win_rate) FROM ({DEALER_DETAIL})",
    }
    for name, query, lift in (
            ("response", RESPONSE_STABILITY, "lift_percentage_points"),
            ("referral", CHANNEL_STABILITY, "referral_lift_percentage_points")):
        for edge in ("min", "max"):
            scalars[f"{name}_lift_pp_{edge}_year"] = f"SELECT {edge}({lift}) FROM ({query})"
    response = f"""SELECT {RESPONSE} AS response_band, count(*) AS inquiries,
        {rate(SOLD)} AS conversion_rate, {mean('price_c', 2)} AS average_sale_value
        FROM fact_inquiry GROUP BY 1"""
    ages = f"""SELECT {AGE} AS vehicle_age_band, count(*) AS inquiries,
        {rate(SOLD)} AS conversion_rate, {mean('spread_c', 2)} AS average_quote_spread,
        {mean('pct_u', 4)} AS average_quote_spread_pct FROM fact_inquiry GROUP BY 1"""
    segment = f"""count(*) AS inquiries, {rate(SOLD)} AS conversion_rate,
        {mean('v.value_c', 2)} AS average_market_value"""
    accepted = f"{total('price_c', 2, zero=True)} AS accepted_value"
    return {
        "e02_evidence": _scalars(scalars),
        "e03_monthly": f"SELECT {MONTH} AS month, count(*) AS inquiries, count(*) FILTER "
                       f"(WHERE {SOLD}) AS conversions, {rate(SOLD)} AS conversion_rate, "
                       f"{accepted} FROM fact_inquiry GROUP BY 1",
        "e04_lead_sources": LEADS,
        "e05_response_bands": _spine("response_band", [
            "<4 hours", "4-8 hours", "8-16 hours", "16-24 hours", "24+ hours"], response),
        "e06_age_bands": _spine("vehicle_age_band", [
            "0-2 years", "3-5 years", "6-9 years", "10+ years"], ages),
        "e07_vehicle_segments": f"SELECT vehicle_type, {segment}, {accepted} FROM {INQ_VEH} "
                                "GROUP BY 1",
        "e08_brands": f"SELECT brand, {segment}, {mean('price_c', 2)} AS average_sale_value, "
                      f"{accepted} FROM {INQ_VEH} GROUP BY 1 "
                      "ORDER BY accepted_value DESC, brand LIMIT 10",
        "e09_dealers": f"{DEALER_DETAIL} ORDER BY win_rate DESC, dealer_id LIMIT 15",
        "e09_dealer_detail": DEALER_DETAIL,
        "e10_annual": f"SELECT year(inquiry_date) AS year, count(*) AS inquiries, "
                      f"{rate(SOLD)} AS conversion_rate, {accepted} FROM fact_inquiry GROUP BY 1",
        "e11_response_by_year": f"""SELECT * EXCLUDE (share, n),
            round({middle} - {margin}, 9) AS ci_95_low, round({middle} + {margin}, 9)
            AS ci_95_high FROM (SELECT *, CAST(inquiries AS DOUBLE) AS n,
              CAST(conversions AS DOUBLE) / inquiries AS share FROM ({RESPONSE_YEAR}))""",
        "e12_response_stability": RESPONSE_STABILITY,
        "e13_channel_by_year": CHANNEL_YEAR,
        "e13_channel_stability": CHANNEL_STABILITY,
        "e16_metadata": "SELECT min(inquiry_date) AS start_date, max(inquiry_date) AS end_date, "
                        "'Inquiry for conversion; quote for dealer competitiveness' "
                        "AS analysis_grain FROM fact_inquiry",
    }


def _bins(table: str, column: str, scale: int) -> str:
    return f"""SELECT b.bin, (lo + CAST((greatest(hi - lo, 1)) * b.bin AS DOUBLE) / 45)
        / {10 ** scale} AS lower_edge, coalesce(c.n, 0) AS rows
        FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) e,
        (SELECT unnest(range(45)) AS bin) b LEFT JOIN (SELECT
          least((({column} - lo) * 45) // greatest(hi - lo, 1), 44) AS bin, count(*) AS n
          FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
          GROUP BY 1) c ON c.bin = b.bin"""


def workbook(min_quotes: int) -> dict[str, str]:
    fields = {"conversion_flag": "CAST(conversion_flag AS INTEGER)",
              "fastest_response_hours": "fastest_c / 100.0",
              "quote_spread_pct": "pct_u / 10000.0", "quote_count": "quote_count",
              "vehicle_age_at_inquiry": "vehicle_age_at_inquiry"}
    fences = percentile_units("fact_quote", [], "ratio_u", {"q1": (1, 4), "q3": (3, 4)})
    outside = ("8 * ratio_u < 2 * q1_t - 3 * (q3_t - q1_t) "
               "OR 8 * ratio_u > 2 * q3_t + 3 * (q3_t - q1_t)")
    keys = {"fact_inquiry": "inquiry_id", "fact_quote": "quote_id", "dim_vehicle": "vehicle_id",
            "dim_dealer": "dealer_id"}
    nullable = {"final_sale_price": "price_c", "winning_dealer_id": "winning_dealer_id",
                "days_to_conversion": "days_to_conversion", "lead_source": "lead_source",
                "vehicle_id": "vehicle_id", "status": "status", "customer_id": "customer_id"}
    return {
        "x01_monthly_growth": f"""SELECT *, CAST(conversions AS DOUBLE) / inquiries
            AS conversion_rate, CAST(inquiries AS DOUBLE) / lag(inquiries) OVER (ORDER BY month)
            - 1 AS month_over_month_growth FROM monthly""",
        "x02_lead_source_lift": f"""SELECT lead_source, inquiries, conversions, conversion_rate,
            (conversion_rate - CAST(sum(conversions) OVER () AS DOUBLE)
              / sum(inquiries) OVER ()) * 100 AS lift_pp,
            rank() OVER (ORDER BY conversion_rate DESC) AS rate_rank FROM ({LEADS})""",
        "x03_dealer_eligibility": f"""SELECT dealer_id, dealer_name, quotes, wins, win_rate,
            quotes >= {min_quotes} AS eligible, CASE WHEN quotes >= {min_quotes} THEN
            rank() OVER (PARTITION BY quotes >= {min_quotes} ORDER BY win_rate DESC) END
            AS eligible_rank FROM ({DEALER_DETAIL})""",
        "x07_overview": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) - count(DISTINCT {k}) "
            f"AS duplicate_keys FROM {t}" for t, k in keys.items()),
        "x07_missingness": "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{n}' AS field, {div_up(f'(count(*) - count({c})) * 100', 'count(*)', 2)} "
            f"AS missing_pct FROM fact_inquiry" for n, c in nullable.items())
            + ") WHERE missing_pct > 0",
        "x08_value_histogram": _bins("dim_vehicle", "value_c", 2),
        "x08_ratio_histogram": _bins("fact_quote", "ratio_u", 4),
        "x09_dealer_comparison": f"""SELECT dealer_id, dealer_name, dealer_region, quotes, wins,
            win_rate, average_response_hours,
            average_quote_to_market_ratio AS quote_to_market_ratio FROM ({DEALER_DETAIL})""",
        "x11_correlations": " UNION ALL ".join(
            f"SELECT '{a}' AS field, '{b}' AS other, round(corr({x}, {y}), 8) AS correlation "
            f"FROM fact_inquiry" for a, x in fields.items() for b, y in fields.items()),
        "x12_outlier_rates": f"""SELECT 'Business-rule quote anomaly' AS "check",
            count(*) FILTER (WHERE anomaly_flag) AS rows, {rate('anomaly_flag')} AS rate
            FROM fact_quote UNION ALL SELECT 'IQR quote-ratio outlier',
            count(*) FILTER (WHERE {outside}), CAST(count(*) FILTER (WHERE {outside}) AS DOUBLE)
            / count(*) FROM fact_quote, ({fences})""",
    }


# Measures as SQL over the inquiry (i) and quote (q) facts.
INQUIRY_MEASURES = {
    "total_inquiries": "count(*)",
    "converted_inquiries": f"count(*) FILTER (WHERE {SOLD})",
    "conversion_rate": rate(SOLD),
    "average_days_to_conversion": mean("days_to_conversion", 0),
    "inquiries_under_sla": "count(*) FILTER (WHERE fastest_c < 800)",
    "sla_compliance_rate": "CAST(count(*) FILTER (WHERE fastest_c < 800) AS DOUBLE) / count(*)",
    "average_highest_quote": mean("high_c", 2), "average_lowest_quote": mean("low_c", 2),
    "average_quote_spread": mean("spread_c", 2), "average_quote_spread_pct": mean("pct_u", 4),
    "average_sale_value": mean("price_c", 2, SOLD),
    "average_fastest_response_time": mean("fastest_c", 2),
}
QUOTE_MEASURES = {
    "total_quotes": "count(*)", "average_quote": mean("amount_c", 2),
    "maximum_quote": units("max(amount_c)", 2), "minimum_quote": units("min(amount_c)", 2),
    "total_accepted_quote_value": total("amount_c", 2, WON),
    "dealer_accepted_value": total("amount_c", 2, WON),
    "quote_to_market_ratio": f"({total('amount_c', 2)} / {total('q.value_c', 2)})",
    "average_estimated_market_value": mean("q.value_c", 2),
    "quote_anomalies": "count(*) FILTER (WHERE anomaly_flag)",
    "quote_anomaly_rate": rate("anomaly_flag"), "average_response_time": mean("hours_c", 2),
    "dealer_wins": f"count(*) FILTER (WHERE {WON})", "dealer_win_rate": rate(WON),
    "average_dealer_competitiveness": mean("ratio_u", 4),
}
INQUIRY_SIDE = "fact_inquiry i LEFT JOIN dim_vehicle v USING (vehicle_id)"
QUOTE_SIDE = ("fact_quote q LEFT JOIN dim_dealer d USING (dealer_id) LEFT JOIN (SELECT "
              "inquiry_id, vehicle_id, inquiry_date, lead_source, fastest_c FROM fact_inquiry) i "
              "USING (inquiry_id) LEFT JOIN dim_vehicle v USING (vehicle_id)")


def grouped(side: str, measures: dict[str, str], names: list[str], keys: dict[str, str],
            where: str = "TRUE") -> str:
    chosen = [f"{measures[n]} AS {n}" for n in names]
    head = [f"{text} AS {name}" for name, text in keys.items()]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}" if keys else ""
    return f"SELECT {', '.join(head + chosen)} FROM {side} WHERE {where}{group}"


def combined(keys: dict[str, str], inquiry: list[str], quote: list[str]) -> str:
    """Both facts at the same keys, aggregated apart and joined on the keys."""
    a = grouped(INQUIRY_SIDE, INQUIRY_MEASURES, inquiry, keys)
    b = grouped(QUOTE_SIDE, QUOTE_MEASURES, quote, keys)
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    head = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)
    values = ", ".join([f"a.{n}" for n in inquiry] + [f"b.{n}" for n in quote])
    return f"SELECT {head}, {values} FROM ({a}) a FULL JOIN ({b}) b ON {same}"


def reports(min_quotes: int, slicers: dict) -> dict[str, str]:
    dealer = {"dealer_id": "dealer_id", "dealer_name": "dealer_name"}
    region = {**dealer, "dealer_region": "dealer_region"}

    def inq(names: str, **keys: str) -> str:
        return grouped(INQUIRY_SIDE, INQUIRY_MEASURES, names.split(), keys)

    def quo(names: str, keys: dict[str, str]) -> str:
        return grouped(QUOTE_SIDE, QUOTE_MEASURES, names.split(), keys)

    totals = quo("total_quotes dealer_wins dealer_win_rate dealer_accepted_value "
                 "average_response_time average_dealer_competitiveness", dealer)
    ranked = f"""(SELECT *, CASE WHEN ok THEN dense_rank() OVER (PARTITION BY ok ORDER BY
        dealer_win_rate DESC) END AS dealer_rank, CASE WHEN ok AND dealer_accepted_value
        IS NOT NULL THEN dense_rank() OVER (PARTITION BY ok ORDER BY dealer_accepted_value DESC
        NULLS LAST) END AS value_rank
        FROM (SELECT *, total_quotes >= {min_quotes} AS ok FROM ({totals})))"""
    top7 = "CASE WHEN dealer_rank <= 7 THEN dealer_win_rate END AS dealer_win_rate_top_7"
    top5 = ("CASE WHEN value_rank <= 5 THEN dealer_accepted_value END "
            "AS dealer_accepted_value_top_5")
    types = {"vehicle_type": "vehicle_type"}
    cards = " ".join(n for n in INQUIRY_MEASURES)
    quote_cards = "total_quotes average_quote maximum_quote minimum_quote " \
                  "total_accepted_quote_value quote_to_market_ratio " \
                  "average_estimated_market_value quote_anomalies quote_anomaly_rate " \
                  "average_response_time dealer_wins dealer_win_rate " \
                  "average_dealer_competitiveness dealer_accepted_value"
    median = percentile_units("fact_quote", [], "amount_c", {"m": (1, 2)})
    by_type = percentile_units(f"(SELECT vehicle_type, amount_c FROM {QUOTE_SIDE})",
                               ["vehicle_type"], "amount_c", {"m": (1, 2)})
    median_value = "(CAST(m_t AS DOUBLE) / (m_b * 100))"
    months = f"""SELECT month, sum(now) AS now, sum(p1) AS p1, sum(c1) AS c1, sum(p12) AS p12,
        sum(now_c) AS now_c, sum(r) AS r, sum(rc) AS rc FROM (
          SELECT month, inquiries AS now, conversions AS now_c, NULL AS p1, NULL AS c1,
            NULL AS p12, inquiries AS r, conversions AS rc FROM monthly
          UNION ALL SELECT CAST(month + INTERVAL 1 MONTH AS DATE), NULL, NULL, inquiries,
            conversions, NULL, inquiries, conversions FROM monthly
          UNION ALL SELECT CAST(month + INTERVAL 2 MONTH AS DATE), NULL, NULL, NULL, NULL, NULL,
            inquiries, conversions FROM monthly
          UNION ALL SELECT CAST(month + INTERVAL 12 MONTH AS DATE), NULL, NULL, NULL, NULL,
            inquiries, NULL, NULL FROM monthly)
        WHERE month IN (SELECT date_trunc('month', date) FROM dim_date) GROUP BY month"""
    year = slicers["year"]

    def members(name: str) -> str:
        return f"{name} IN ({', '.join(repr(x) for x in slicers[name])})"

    common = (f"{members('lead_source')} AND {members('vehicle_type')} "
              f"AND year(inquiry_date) BETWEEN {year[0]} AND {year[1]}")
    lead = {"lead_source": "lead_source"}
    sliced_i = grouped(INQUIRY_SIDE, INQUIRY_MEASURES, ["total_inquiries", "conversion_rate"],
                       lead, common)
    sliced_q = grouped(QUOTE_SIDE, QUOTE_MEASURES,
                       ["total_quotes", "dealer_win_rate", "average_quote"], lead,
                       f"{common} AND {members('dealer_region')}")
    return {
        "r01": inq("total_inquiries converted_inquiries conversion_rate", month_start=MONTH),
        "r02": inq("conversion_rate total_inquiries converted_inquiries",
                   lead_source="lead_source"),
        "r03": combined(types, ["total_inquiries", "conversion_rate"],
                        ["total_accepted_quote_value"]),
        "r04": f"SELECT dealer_id, dealer_name, {top5}, dealer_win_rate, total_quotes "
               f"FROM {ranked}",
        "r05": quo("average_quote quote_to_market_ratio", {"dealer_region": "dealer_region"}),
        "r06": inq("average_quote_spread average_quote_spread_pct", vehicle_type="vehicle_type"),
        "r07": quo("average_estimated_market_value average_quote total_quotes "
                   "quote_to_market_ratio", {"brand": "brand", **types}),
        "r08": combined({**types, "brand": "brand"},
                        ["average_quote_spread", "average_quote_spread_pct"],
                        ["average_estimated_market_value", "average_quote",
                         "quote_to_market_ratio"]),
        "r09": inq("conversion_rate total_inquiries", response_band=REPORT_BAND,
                   response_band_order=REPORT_ORDER),
        "r10": inq("conversion_rate total_inquiries converted_inquiries average_sale_value",
                   lead_source="lead_source"),
        "r11": inq("total_inquiries converted_inquiries conversion_rate "
                   "average_fastest_response_time average_sale_value",
                   lead_source="lead_source"),
        "r12": inq("conversion_rate total_inquiries", mileage_bracket="mileage_bracket"),
        "r13": f"SELECT dealer_id, dealer_name, {top7}, total_quotes, average_response_time, "
               f"dealer_accepted_value FROM {ranked}",
        "r14": quo("average_response_time dealer_win_rate total_quotes dealer_accepted_value",
                   region),
        "r15": quo("total_quotes dealer_win_rate average_response_time "
                   "average_dealer_competitiveness dealer_accepted_value",
                   {**region, "dealer_rating": units("rating_c", 2)}),
        "r16": f"SELECT dealer_id, dealer_name, {top5}, dealer_win_rate, "
               f"average_dealer_competitiveness FROM {ranked}",
        "measure_inquiry": f"""SELECT *, CAST((SELECT count(*) FROM fact_quote) AS DOUBLE)
            / total_inquiries AS average_quotes_per_inquiry FROM ({inq(cards)})""",
        "measure_quote": f"""SELECT a.*, {median_value} AS median_quote,
            (SELECT count(*) FROM dim_dealer WHERE active_flag) AS active_dealers
            FROM ({quo(quote_cards, {})}) a, ({median})""",
        "measure_series": f"""SELECT month AS month_start, now AS total_inquiries,
            p1 AS previous_month_inquiries,
            CAST(now - p1 AS DOUBLE) / nullif(p1, 0) AS month_over_month_inquiry_growth,
            p12 AS previous_year_inquiries,
            CAST(now - p12 AS DOUBLE) / nullif(p12, 0) AS year_over_year_inquiry_growth,
            CAST(c1 AS DOUBLE) / nullif(p1, 0) AS previous_month_conversion_rate,
            CAST(now_c AS DOUBLE) / now - CAST(c1 AS DOUBLE) / nullif(p1, 0)
              AS conversion_rate_change,
            CAST(rc AS DOUBLE) / nullif(r, 0) AS rolling_3m_conversion_rate FROM ({months})""",
        "measure_series_sliced": f"""SELECT month AS month_start, now AS total_inquiries,
            p1 AS previous_month_inquiries, p12 AS previous_year_inquiries,
            CAST(rc AS DOUBLE) / nullif(r, 0) AS rolling_3m_conversion_rate FROM ({months})
            WHERE month BETWEEN DATE '1996-03-01' AND DATE '1998-12-01'""",
        "measure_series_by_year": f"""SELECT month AS month_start, year(month) AS year,
            now AS total_inquiries, p1 AS previous_month_inquiries,
            CAST(rc AS DOUBLE) / nullif(r, 0) AS rolling_3m_conversion_rate FROM ({months})
            WHERE coalesce(now, p1, r) IS NOT NULL""",
        "measure_rank_by_month": f"""SELECT month_start, dealer_id, total_quotes,
            CASE WHEN total_quotes >= 5 THEN dense_rank() OVER (PARTITION BY month_start,
            total_quotes >= 5 ORDER BY dealer_win_rate DESC) END AS dealer_rank
            FROM ({quo("total_quotes dealer_win_rate",
                       {"month_start": MONTH, "dealer_id": "dealer_id"})})""",
        "measure_rank_by_type": f"""SELECT vehicle_type, dealer_id, dealer_name,
            CASE WHEN ok AND dealer_accepted_value IS NOT NULL AND dense_rank() OVER (
            PARTITION BY vehicle_type, ok ORDER BY dealer_accepted_value DESC NULLS LAST) <= 5
            THEN dealer_accepted_value END AS dealer_accepted_value_top_5
            FROM (SELECT *, total_quotes >= 20 AS ok FROM (
            {quo("total_quotes dealer_accepted_value", {**types, **dealer})}))""",
        "measure_null_source": f"""SELECT b.lead_source, dealer_id, total_quotes, total_inquiries
            FROM ({quo("total_quotes", {"lead_source": "lead_source",
                                        "dealer_id": "dealer_id"})}) b
            LEFT JOIN ({inq("total_inquiries", lead_source="lead_source")}) a
            ON a.lead_source IS NOT DISTINCT FROM b.lead_source""",
        "measure_quotes_by_quote_date": f"""SELECT coalesce(a.m, b.m) AS month_start,
            a.n AS total_quotes, b.n AS total_quotes_by_quote_date
            FROM (SELECT {MONTH} AS m, count(*) AS n FROM fact_quote JOIN fact_inquiry
              USING (inquiry_id) GROUP BY 1) a
            FULL JOIN (SELECT CAST(date_trunc('month', quote_date) AS DATE) AS m, count(*) AS n
              FROM fact_quote GROUP BY 1) b ON a.m = b.m""",
        "measure_dealer_rank": f"SELECT dealer_id, dealer_name, total_quotes, dealer_rank "
                               f"FROM {ranked}",
        "measure_median_by_type": f"SELECT vehicle_type, {median_value} AS median_quote, "
                                  f"n AS total_quotes FROM ({by_type})",
        "measure_sliced": f"""SELECT coalesce(a.lead_source, b.lead_source) AS lead_source,
            total_inquiries, conversion_rate, total_quotes, dealer_win_rate, average_quote
            FROM ({sliced_i}) a FULL JOIN ({sliced_q}) b ON a.lead_source = b.lead_source""",
    }


def statements(guards: dict, min_quotes: int, slicers: dict) -> dict[str, str]:
    found = {**curated(), **views(), **business(guards), **audits(), **evidence(),
             **workbook(min_quotes), **reports(min_quotes, slicers)}
    texts = {}
    for name, select in found.items():
        extra = [MONTHLY] if " monthly" in select else []
        extra += [DEALER_PERFORMANCE] if "vw_dealer" in select else []
        texts[name] = with_base(*extra) + select
    return {**texts, **operations()}
