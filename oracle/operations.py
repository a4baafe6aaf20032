"""SQL of the quality, quarantine and run tables and of what is computed from them."""

from __future__ import annotations

from oracle.base import mean, rate, total, units, with_base

def _cents(column: str) -> str:
    """Whole cents as the text of a decimal of scale 2."""
    return (f"CASE WHEN {column} < 0 THEN '-' ELSE '' END || (abs({column}) // 100) || '.' || "
            f"lpad((abs({column}) % 100)::VARCHAR, 2, '0')")


def _row(**fields: str) -> str:
    """A row as JSON text, its keys in order and NULL spelled out."""
    told = ", ".join(f"{k}: coalesce(({fields[k]})::VARCHAR, '<NULL>')" for k in sorted(fields))
    return f"to_json({{{told}}})::VARCHAR"


_CUSTOMER = _row(
    customer_id="customer_id", lead_source="raw_lead", customer_type="' ' || c_mktsegment",
    customer_created_date="CASE WHEN balance < -950 THEN '2025-99-41' "
                          "ELSE CAST(created AS DATE)::VARCHAR END",
    age_group="CASE WHEN balance < 1500 THEN '18-24' WHEN balance < 4000 THEN '25-34' WHEN "
              "balance < 6500 THEN '35-44' WHEN balance < 9000 THEN '45-64' ELSE '65+ years' END",
    canton="CASE WHEN copy = 1 THEN 'ZZ' WHEN balance BETWEEN 0 AND 150 THEN '  ' "
           "ELSE lower(n_name) END",
    preferred_contact_method="(ARRAY['email', 'PHONE', 'text message', 'in-person', 'Email'])"
                             "[n_regionkey + 1]")
_VEHICLE = _row(
    vehicle_id="vehicle_id", brand="'  ' || upper(p_brand)", model="p_name || ' '",
    vehicle_type="p_type", manufacture_year="v.manufacture_year", mileage_km="raw_km",
    fuel_type="CASE WHEN p_size = 25 THEN 'steam' WHEN p_type <> 'PROMO' OR p_size >= 10 THEN "
              "(ARRAY['petrol ', 'DIESEL', 'Hybrid', 'electric', 'Petrol'])[p_size % 5 + 1] END",
    estimated_market_value=_cents("v.value_c"),
    vehicle_condition="CASE WHEN p_size < 13 THEN 'excellent' WHEN p_size < 26 THEN 'Good' "
                      "WHEN p_size < 38 THEN 'FAIR ' ELSE 'poor' END")
_DEALER = _row(
    dealer_id="dealer_id", dealer_region="r_name", dealer_rating=_cents("rating_c"),
    dealer_name="CASE WHEN balance < 0 THEN '  ' || s_name ELSE s_name END",
    dealer_type="CASE WHEN copy = 1 THEN 'Broker' ELSE "
                "(ARRAY['Franchise', ' Independent', 'Broker '])[s_nationkey % 3 + 1] END",
    active_flag="CASE WHEN balance >= 500 THEN 'Yes' ELSE 'no' END")
_INQUIRY = _row(
    inquiry_id="inquiry_id", customer_id="customer_id", vehicle_id="vehicle_id",
    inquiry_date="CASE WHEN amount < 6000 THEN '2025-99-41' ELSE order_day::VARCHAR END",
    lead_source="CASE o_orderpriority WHEN '1-URGENT' THEN '  dealer referral ' WHEN '2-HIGH' "
                "THEN 'Social Media' WHEN '3-MEDIUM' THEN 'ORGANIC SEARCH' WHEN '4-NOT SPECIFIED' "
                "THEN 'paid search ' WHEN '5-LOW' THEN 'Direct' END",
    status="CASE WHEN copy = 1 THEN 'Open' WHEN o_orderstatus = 'P' AND amount > 400000 THEN "
           "'Expired' WHEN o_orderstatus = 'P' THEN 'lost' WHEN o_orderstatus = 'O' THEN 'OPEN' "
           "ELSE ' converted ' END",
    final_sale_price=f"CASE WHEN o_orderstatus = 'F' THEN {_cents('best_price_c')} END",
    winning_dealer_id="raw_winner",
    conversion_flag="CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'no' END",
    days_to_conversion="CASE WHEN o_orderstatus = 'F' THEN "
                       "abs(date_diff('day', order_day, best_day)) END")
_QUOTE = _row(
    quote_id="quote_id", inquiry_id="inquiry_id", quote_rank="l_linenumber",
    dealer_id="CASE WHEN l_returnflag = 'R' THEN ' ' || lower(dealer_id) ELSE dealer_id END",
    quote_date="CASE WHEN quote_date IS NULL THEN 'not-a-date' ELSE ship_day::VARCHAR END",
    quote_amount=f"CASE amount_c WHEN -100 THEN '-1' WHEN 999999900 THEN '9999999' "
                 f"ELSE {_cents('price_c')} END",
    response_time_hours=_cents("hours_c"),
    accepted_flag="CASE WHEN accepted THEN 'true' ELSE 'false' END")

# k holds the source order: files are in the order of their keys, re-sent copies come after them.
_NUMBER = "substr({0}, 2)::BIGINT".format
REJECTS = f"""rejects AS MATERIALIZED (
  SELECT 'dim_customer' AS table_name, 1 AS t, customer_id AS record_id, CASE WHEN rn > 1
    THEN 'duplicate_primary_key' ELSE 'malformed_customer_date' END AS issue_type,
    [copy, {_NUMBER("customer_id")}] AS k, {_CUSTOMER} AS record_payload
    FROM tagged_customer WHERE rn > 1 OR created IS NULL
  UNION ALL SELECT 'dim_vehicle', 2, vehicle_id, 'invalid_vehicle_domain', [0, p_partkey],
    {_VEHICLE} FROM tagged_vehicle AS v JOIN part ON vehicle_id = 'V' || p_partkey
    WHERE vehicle_id NOT IN (SELECT vehicle_id FROM dim_vehicle)
  UNION ALL SELECT 'dim_dealer', 3, dealer_id, CASE WHEN rn > 1 THEN 'duplicate_primary_key'
    ELSE 'invalid_dealer_rating' END, [copy, {_NUMBER("dealer_id")}], {_DEALER}
    FROM tagged_dealer WHERE rn > 1 OR rating_c NOT BETWEEN 0 AND 500
  UNION ALL SELECT 'fact_inquiry', 4, inquiry_id, rule, [copy, {_NUMBER("inquiry_id")}],
    {_INQUIRY} FROM tagged_inquiry WHERE rule IS NOT NULL
  UNION ALL SELECT 'fact_inquiry', 4, inquiry_id, 'inquiry_without_quote',
    [copy, {_NUMBER("inquiry_id")}], {_INQUIRY} FROM reconciled WHERE quote_count IS NULL
  UNION ALL SELECT 'fact_quote', 5, quote_id, rule, [date_diff('day', DATE '1970-01-01', ship_day),
    l_partkey, l_suppkey, price_c], {_QUOTE} FROM tagged_quote WHERE rule IS NOT NULL)"""

ACTIONS = """actions(issue_type, r, action) AS (VALUES
  ('duplicate_primary_key', 1, 'Keep first occurrence; quarantine later duplicate'),
  ('malformed_customer_date', 2,
    'Quarantine because registration sequence cannot be validated'),
  ('invalid_vehicle_domain', 2,
    'Quarantine values that cannot be corrected without inventing business data'),
  ('invalid_dealer_rating', 2, 'Quarantine rating outside the documented 0-5 range'),
  ('malformed_inquiry_date', 2,
    'Quarantine because time-series placement and date sequence are unknown'),
  ('invalid_inquiry_foreign_key', 3,
    'Quarantine orphan inquiry until the parent entity is repaired'),
  ('customer_date_sequence', 4, 'Quarantine inquiry dated before customer registration'),
  ('inquiry_without_quote', 5, 'Quarantine inquiry left with no loadable quote'),
  ('invalid_quote_domain', 2, 'Quarantine malformed dates or impossible monetary amounts'),
  ('invalid_quote_foreign_key', 3,
    'Quarantine orphan quote until dealer or inquiry key is repaired'),
  ('quote_date_sequence', 4, 'Quarantine quote dated before its inquiry'))"""

FIXES = """fixes AS MATERIALIZED (
  SELECT 'dim_customer' AS table_name, 'missing_canton' AS issue_type,
    (SELECT count(*) FROM dim_customer WHERE canton = 'Unknown') AS affected_rows, TRUE AS fix,
    'Replace missing optional geography with explicit Unknown member' AS action,
    'Rows retained; unknowns remain visible in reporting' AS final_result
  UNION ALL SELECT 'dim_customer', 'inconsistent_lead_source_text', (SELECT count(*)
    FROM tagged_customer WHERE rn = 1 AND created IS NOT NULL AND raw_lead <> lead), TRUE,
    'Trim and case-normalize to approved lead-source values', 'Canonical categories restored'
  UNION ALL SELECT 'dim_vehicle', 'missing_fuel_type', (SELECT count(*) FROM tagged_vehicle
    WHERE fuel_type = 'Unknown'), TRUE,
    'Replace missing optional fuel type with explicit Unknown member',
    'Rows retained without inventing a fuel classification'
  UNION ALL SELECT 'dim_vehicle', 'negative_mileage_sign_error', (SELECT count(*)
    FROM tagged_vehicle WHERE raw_km < 0 AND mileage_km <= 500000), TRUE,
    'Take absolute value only when magnitude remains inside the accepted domain',
    'Plausible sign errors corrected and retained'
  UNION ALL SELECT 'dim_dealer', 'dealer_name_whitespace', (SELECT count(*) FROM tagged_dealer
    WHERE balance < 0), TRUE, 'Trim leading and trailing whitespace',
    'Dealer labels standardized'
  UNION ALL SELECT 'fact_inquiry', 'accepted_quote_removed_by_quality_rule', (SELECT count(*)
    FROM reconciled WHERE downgraded), TRUE,
    'Downgrade conversion when its accepted quote is not loadable',
    'Fact tables remain internally consistent; affected outcomes are not overstated'
  UNION ALL SELECT 'fact_inquiry', 'winning_dealer_mismatch', (SELECT count(*) FROM reconciled
    WHERE conversion_flag AND raw_winner <> won_dealer), TRUE,
    'Derive winner and final sale price from the single accepted quote',
    'Commercial outcomes reconciled across both fact tables'
  UNION ALL SELECT 'fact_quote', 'missing_response_time', (SELECT count(*) FROM fact_quote
    WHERE imputed), TRUE, 'Impute the dealer median, falling back to the portfolio median',
    'Rows retained; imputation rule documented and reproducible'
  UNION ALL SELECT 'fact_quote', 'accepted_quote_without_conversion', (SELECT count(*)
    FROM fact_quote WHERE cleared), TRUE,
    'Clear the accepted flag of quotes whose inquiry is not converted',
    'Quote outcomes reconciled with inquiry outcomes'
  UNION ALL SELECT 'fact_quote', 'quote_to_market_anomaly', (SELECT count(*) FROM fact_quote
    WHERE anomaly_flag), FALSE,
    'Retain plausible positive quote and set anomaly_flag for review',
    'Outliers remain analytically visible without contaminating hard-validity checks')"""

ISSUES = """issues AS MATERIALIZED (
  SELECT table_name, issue_type, affected_rows, action, final_result FROM fixes
    WHERE affected_rows > 0
  UNION ALL SELECT table_name, issue_type, count(*), action, format('{:,}', count(*))
    || ' row(s) excluded from the curated layer' FROM rejects JOIN actions USING (issue_type)
    GROUP BY table_name, issue_type, action)"""

# Column -> (raw "is present" test, curated "is present" test); TRUE where it cannot be missing.
_T = ("TRUE", "TRUE")
COMPLETE = {
    "dim_customer": dict.fromkeys(
        ["customer_id", "customer_created_date", "age_group", "canton", "customer_type",
         "preferred_contact_method"], _T) | {"lead_source": ("TRUE", "lead_source IS NOT NULL")},
    "dim_vehicle": dict.fromkeys(
        ["vehicle_id", "brand", "model", "vehicle_type", "manufacture_year", "mileage_km",
         "estimated_market_value", "vehicle_condition"], _T) | {
        "fuel_type": ("NOT raw_fuel_missing", "TRUE")},
    "dim_dealer": dict.fromkeys(
        ["dealer_id", "dealer_name", "dealer_region", "dealer_type", "dealer_rating",
         "active_flag"], _T),
    "fact_inquiry": dict.fromkeys(
        ["inquiry_id", "customer_id", "inquiry_date", "status", "conversion_flag"], _T) | {
        "vehicle_id": ("vehicle_id IS NOT NULL",) * 2,
        "lead_source": ("lead_source IS NOT NULL",) * 2},
    "fact_quote": dict.fromkeys(
        ["quote_id", "inquiry_id", "dealer_id", "quote_date", "quote_amount", "quote_rank",
         "accepted_flag"], _T) | {"response_time_hours": ("hours_c IS NOT NULL",) * 2},
    "dim_date": dict.fromkeys(["date", "year", "quarter", "month", "month_name"], _T),
}
VALID = {
    "dim_vehicle": {"mileage": ("raw_km BETWEEN 0 AND 500000", "mileage_km BETWEEN 0 AND 500000"),
                    "market_value": ("value_c > 0",) * 2,
                    "year": ("manufacture_year BETWEEN 1990 AND 2025",) * 2},
    "dim_dealer": {"rating": ("rating_c BETWEEN 0 AND 500",) * 2},
    "fact_inquiry": {"inquiry_date": ("inquiry_date IS NOT NULL",) * 2},
    "fact_quote": {"amount": ("amount_c > 0 AND amount_c <= 50000000",) * 2,
                   "quote_date": ("quote_date IS NOT NULL",) * 2,
                   "response": ("hours_c >= 0",) * 2},
}
RAW_NAMES = {"dim_customer": "tagged_customer", "dim_vehicle": "tagged_vehicle",
             "dim_dealer": "tagged_dealer", "fact_inquiry": "tagged_inquiry",
             "fact_quote": "raw_quote", "dim_date": "dim_date"}
KEYS = {"dim_customer": "customer_id", "dim_vehicle": "vehicle_id", "dim_dealer": "dealer_id",
        "fact_inquiry": "inquiry_id", "fact_quote": "quote_id", "dim_date": "date"}


def _links(raw: bool) -> list[tuple[str, str, str, str, str]]:
    """(name, child, foreign key, parent, key); raw keys carry their raw spelling."""
    dealer = "CASE WHEN l_returnflag = 'R' THEN ' d' ELSE 'D' END || l_suppkey"
    names = RAW_NAMES if raw else {n: n for n in RAW_NAMES}
    return [
        ("fact_inquiry.customer_id", names["fact_inquiry"], "customer_id",
         names["dim_customer"], "customer_id"),
        ("fact_inquiry.vehicle_id", names["fact_inquiry"], "vehicle_id",
         names["dim_vehicle"], "vehicle_id"),
        ("fact_quote.inquiry_id", names["fact_quote"], "inquiry_id", names["fact_inquiry"],
         "inquiry_id"),
        ("fact_quote.dealer_id", names["fact_quote"], dealer if raw else "dealer_id",
         names["dim_dealer"], "dealer_id"),
        ("fact_inquiry.winning_dealer_id", names["fact_inquiry"],
         "raw_winner" if raw else "winning_dealer_id", names["dim_dealer"], "dealer_id"),
    ]


def checks(raw: bool) -> str:
    """Every single check as (metric_name, check, passed, checked)."""
    side = 0 if raw else 1
    parts = []
    for metric, rules in (("completeness_rate", COMPLETE), ("validity_rate", VALID)):
        for table, tests in rules.items():
            source = RAW_NAMES[table] if raw else table
            parts += [f"SELECT '{metric}', '{name}', count(*) FILTER (WHERE {test[side]}), "
                      f"count(*) FROM {source}" for name, test in tests.items()]
    for table, key in KEYS.items():
        source = RAW_NAMES[table] if raw else table
        parts.append(f"SELECT 'uniqueness_rate', '{key}', count(DISTINCT {key}), count(*) "
                     f"FROM {source}")
    for name, child, foreign, parent, key in _links(raw):
        parts.append(f"SELECT 'referential_integrity_rate', '{name}', count(*) FILTER (WHERE "
                     f"fk IS NULL OR fk IN (SELECT {key} FROM {parent})), count(*) "
                     f"FROM (SELECT {foreign} AS fk FROM {child})")
    return " UNION ALL ".join(parts)


METRICS = f"""raw_checks(metric_name, "check", passed, checked) AS MATERIALIZED ({checks(True)}),
done_checks(metric_name, "check", passed, checked) AS MATERIALIZED ({checks(False)}),
stage_checks AS (SELECT 'Raw' AS stage, * FROM raw_checks
  UNION ALL SELECT 'Processed', * FROM done_checks),
dq AS MATERIALIZED (SELECT metric_name, stage, CAST(sum(passed) AS BIGINT) AS passed_records,
    CAST(sum(checked) AS BIGINT) AS total_records,
    CAST(sum(passed) AS DOUBLE) / CAST(sum(checked) AS DOUBLE) AS rate,
    CASE metric_name
      WHEN 'completeness_rate' THEN 'Required fields populated at the applicable table grain'
      WHEN 'validity_rate'
        THEN 'Values conform to documented types, dates, and business ranges'
      WHEN 'uniqueness_rate' THEN 'Primary-key rows are unique at the declared table grain'
      WHEN 'referential_integrity_rate'
        THEN 'Fact foreign keys resolve to curated parent records'
      ELSE 'Passed checks divided by applicable checks across all four dimensions'
      END AS description, DATE '2026-01-01' AS assessment_date
  FROM (SELECT * FROM stage_checks UNION ALL
    SELECT stage, 'overall_data_quality_score', "check", passed, checked FROM stage_checks)
  GROUP BY metric_name, stage)"""

RUNS = "runs AS MATERIALIZED (" + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {RAW_NAMES[t]}) AS raw_records,
    (SELECT count(*) FROM rejects WHERE table_name = '{t}'
      AND issue_type = 'duplicate_primary_key') AS duplicate_records,
    (SELECT CAST(coalesce(sum(affected_rows), 0) AS BIGINT) FROM fixes
      WHERE table_name = '{t}' AND fix) AS corrected_records,
    (SELECT count(DISTINCT record_id) FROM rejects WHERE table_name = '{t}')
      AS quarantined_records, (SELECT count(*) FROM {t}) AS clean_records,
    0 AS loaded_records, 'Ready' AS load_status""" for t in KEYS) + ")"

PIPELINE_STAGE = """CASE table_name WHEN 'dim_customer' THEN 'Customer dimension'
  WHEN 'dim_vehicle' THEN 'Vehicle dimension' WHEN 'dim_dealer' THEN 'Dealer dimension'
  WHEN 'fact_inquiry' THEN 'Inquiry fact' WHEN 'fact_quote' THEN 'Quote fact'
  WHEN 'dim_date' THEN 'Date dimension' ELSE 'Other' END"""
METRIC_LABEL = """CASE metric_name WHEN 'completeness_rate' THEN 'Completeness'
  WHEN 'overall_data_quality_score' THEN 'Overall quality score'
  WHEN 'referential_integrity_rate' THEN 'Referential integrity'
  WHEN 'uniqueness_rate' THEN 'Uniqueness' WHEN 'validity_rate' THEN 'Validity'
  ELSE 'Other' END"""
CATEGORY = """CASE WHEN issue_type LIKE '%duplicate%' THEN 'Duplicate keys'
  WHEN issue_type LIKE '%foreign\\_key%' ESCAPE '\\' THEN 'Referential integrity'
  WHEN issue_type LIKE '%missing%' THEN 'Missing values'
  WHEN issue_type LIKE '%domain%' THEN 'Invalid domain values'
  WHEN issue_type LIKE '%anomaly%' THEN 'Pricing anomalies'
  WHEN issue_type LIKE '%date%' THEN 'Invalid dates'
  WHEN issue_type LIKE '%whitespace%' OR issue_type LIKE '%text%' THEN 'Standardisation'
  WHEN issue_type LIKE '%mismatch%' OR issue_type LIKE '%removed%'
    OR issue_type LIKE '%sign\\_error%' ESCAPE '\\' THEN 'Business-rule correction'
  ELSE 'Other' END"""


def _rate_of(stage: str, metric: str) -> str:
    return f"max(rate) FILTER (WHERE stage = '{stage}' AND metric_name = '{metric}')"


def load_checks() -> str:
    parts = [f"SELECT 'unique_{k}' AS check_name, count(*) - count(DISTINCT {k}) AS failures "
             f"FROM {t}" for t, k in KEYS.items()]
    domains = {
        "valid_mileage": ("dim_vehicle", "mileage_km BETWEEN 0 AND 500000"),
        "valid_manufacture_year": ("dim_vehicle", "manufacture_year BETWEEN 1990 AND 2025"),
        "valid_dealer_rating": ("dim_dealer", "rating_c BETWEEN 0 AND 500"),
        "valid_quote_amount": ("fact_quote", "amount_c > 0 AND amount_c <= 50000000"),
        "valid_response_time": ("fact_quote", "hours_c >= 0"),
        "conversion_status_consistency":
            ("fact_inquiry", "(status = 'Converted') = conversion_flag"),
        "inquiry_customer_fk":
            ("fact_inquiry", "customer_id IN (SELECT customer_id FROM dim_customer)"),
        "inquiry_vehicle_fk":
            ("fact_inquiry", "vehicle_id IN (SELECT vehicle_id FROM dim_vehicle)"),
        "quote_inquiry_fk": ("fact_quote", "inquiry_id IN (SELECT inquiry_id FROM fact_inquiry)"),
        "quote_dealer_fk": ("fact_quote", "dealer_id IN (SELECT dealer_id FROM dim_dealer)"),
        "inquiry_date_fk": ("fact_inquiry", "inquiry_date IN (SELECT date FROM dim_date)"),
        "quote_date_fk": ("fact_quote", "quote_date IN (SELECT date FROM dim_date)"),
        "quote_date_sequence": ("(SELECT quote_date, inquiry_date FROM fact_quote "
                                "JOIN fact_inquiry USING (inquiry_id))",
                                "quote_date >= inquiry_date"),
        "accepted_quote_rule": (
            "(SELECT conversion_flag, winning_dealer_id, (SELECT count(*) FROM fact_quote q "
            "WHERE q.inquiry_id = i.inquiry_id AND accepted_flag) AS n, (SELECT min(dealer_id) "
            "FROM fact_quote q WHERE q.inquiry_id = i.inquiry_id AND accepted_flag) AS d "
            "FROM fact_inquiry i)",
            "CASE WHEN conversion_flag THEN n = 1 AND d = winning_dealer_id ELSE n = 0 END"),
        "accepted_value_reconciliation": (
            "(SELECT price_c, amount_c FROM fact_inquiry LEFT JOIN (SELECT inquiry_id, amount_c "
            "FROM fact_quote WHERE accepted_flag) USING (inquiry_id) WHERE conversion_flag)",
            "abs(price_c - amount_c) <= 1"),
        "quote_summary_reconciliation": (
            "(SELECT quote_count, high_c, low_c, fastest_c, n, h, l, f FROM fact_inquiry LEFT "
            "JOIN (SELECT inquiry_id, count(*) AS n, max(amount_c) AS h, min(amount_c) AS l, "
            "min(hours_c) AS f FROM fact_quote GROUP BY 1) USING (inquiry_id))",
            "quote_count = n AND high_c = h AND low_c = l AND fastest_c = f"),
    }
    parts += [f"SELECT '{name}', count(*) FILTER (WHERE NOT coalesce({test}, FALSE)) FROM {t}"
              for name, (t, test) in domains.items()]
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


DOMAINS = {
    "dim_date": {"month_range": "month(date) BETWEEN 1 AND 12",
                 "week_range": "week(date) BETWEEN 1 AND 53"},
    "dim_vehicle": {"vehicle_year": "manufacture_year BETWEEN 1990 AND 2025",
                    "vehicle_mileage": "mileage_km BETWEEN 0 AND 500000",
                    "vehicle_value": "value_c > 0"},
    "dim_dealer": {"dealer_rating": "rating_c BETWEEN 0 AND 500"},
    "fact_inquiry": {
        "status_domain": "status IN ('Converted', 'Lost', 'Expired', 'Open')",
        "quote_count_positive": "quote_count > 0", "spread_not_negative": "spread_c >= 0",
        "spread_pct_not_negative": "pct_u >= 0",
        "age_not_negative": "vehicle_age_at_inquiry >= 0",
        "conversion_consistency": "conversion_flag = (price_c IS NOT NULL) AND "
                                  "conversion_flag = (winning_dealer_id IS NOT NULL)"},
    "fact_quote": {"amount_range": "amount_c > 0 AND amount_c <= 50000000",
                   "hours_not_negative": "hours_c >= 0", "rank_positive": "quote_rank > 0",
                   "value_positive": "value_c > 0", "ratio_positive": "ratio_u > 0"},
}


def constraints() -> str:
    rules = DOMAINS | {
        "(SELECT count(*) AS n FROM fact_quote WHERE accepted_flag GROUP BY inquiry_id)": {
            "one_accepted_quote_per_inquiry": "n <= 1"},
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {test}) AS passed, "
        f"count(*) AS checked FROM {table}"
        for table, tests in rules.items() for name, test in tests.items())


PROFILE = {
    "dim_customer": dict.fromkeys(
        ["customer_id", "customer_created_date", "age_group", "canton", "customer_type",
         "preferred_contact_method", "lead_source"]),
    "dim_vehicle": dict.fromkeys(
        ["vehicle_id", "brand", "model", "vehicle_type", "fuel_type", "manufacture_year",
         "mileage_km", "vehicle_condition", "mileage_bracket", "market_value_band"]) | {
        "estimated_market_value": ("value_c", 2)},
    "dim_dealer": dict.fromkeys(
        ["dealer_id", "dealer_name", "dealer_region", "dealer_type", "active_flag"]) | {
        "dealer_rating": ("rating_c", 2)},
    "fact_inquiry": dict.fromkeys(
        ["inquiry_id", "customer_id", "vehicle_id", "inquiry_date", "lead_source", "status",
         "winning_dealer_id", "conversion_flag", "days_to_conversion", "quote_count",
         "vehicle_age_at_inquiry"]) | {
        "final_sale_price": ("price_c", 2), "highest_quote": ("high_c", 2),
        "lowest_quote": ("low_c", 2), "average_quote": ("avg_c", 2),
        "fastest_response_hours": ("fastest_c", 2), "quote_spread": ("spread_c", 2),
        "quote_spread_pct": ("pct_u", 4)},
    "fact_quote": dict.fromkeys(
        ["quote_id", "inquiry_id", "dealer_id", "quote_date", "quote_rank", "accepted_flag",
         "anomaly_flag"]) | {
        "quote_amount": ("amount_c", 2), "response_time_hours": ("hours_c", 2),
        "estimated_market_value": ("value_c", 2), "quote_to_market_ratio": ("ratio_u", 4)},
    "dim_date": {"date": None, "year": "year(date)", "quarter": "'Q' || quarter(date)",
                 "month": "month(date)", "month_name": "monthname(date)", "week": "week(date)",
                 "day_of_week": "dayname(date)", "is_weekend": "isodow(date) >= 6"},
}


def profile() -> str:
    def text(name: str, spec) -> str:
        if spec is None:
            return f"CAST({name} AS VARCHAR)"
        if isinstance(spec, str):
            return f"CAST({spec} AS VARCHAR)"
        column, scale = spec
        return f"CAST(CAST({column} AS DECIMAL(18,0)) * CAST(1e-{scale} AS DECIMAL({scale + 1}," \
               f"{scale})) AS VARCHAR)"

    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS field, count(*) AS rows, "
        f"CAST(count(*) - count(v) AS DOUBLE) / count(*) AS null_rate, "
        f"count(DISTINCT v) AS distinct_values, min(v) AS example "
        f"FROM (SELECT {text(name, spec)} AS v FROM {table})"
        for table, columns in PROFILE.items() for name, spec in columns.items())


PRIMARY = {t: [k] for t, k in KEYS.items()} | {
    "data_quality_metrics": ["metric_name", "stage", "assessment_date"],
    "data_quality_issue_log": ["issue_id"], "quarantined_records": ["quarantine_id"],
    "pipeline_run_summary": ["table_name"]}
OPTIONAL = ["final_sale_price", "winning_dealer_id", "days_to_conversion"]
LINKS = {"fact_inquiry": {"customer_id": "dim_customer", "vehicle_id": "dim_vehicle",
                          "inquiry_date": "dim_date", "winning_dealer_id": "dim_dealer"},
         "fact_quote": {"inquiry_id": "fact_inquiry", "dealer_id": "dim_dealer",
                        "quote_date": "dim_date"}}


def schema_constraints(operational: dict[str, str]) -> str:
    """Every declared constraint over the six tables and the operational tables given as SQL."""
    columns = {t: {c: (spec[0] if isinstance(spec, tuple) else spec or c)
                   for c, spec in found.items()} for t, found in PROFILE.items()}
    columns |= {t: {c: c for c in found} for t, found in {
        "data_quality_metrics": ["metric_name", "stage", "passed_records", "total_records", "rate",
                                 "description", "assessment_date"],
        "data_quality_issue_log": ["issue_id", "table_name", "issue_type", "affected_rows",
                                   "action", "final_result"],
        "quarantined_records": ["quarantine_id", "table_name", "record_id", "issue_type", "action",
                                "detected_at", "record_payload"],
        "pipeline_run_summary": ["table_name", "raw_records", "duplicate_records",
                                 "corrected_records", "quarantined_records", "clean_records",
                                 "loaded_records", "load_status"]}.items()}
    domain = {t: dict(rules) for t, rules in DOMAINS.items()} | {
        "data_quality_metrics": {"stage_domain": "stage IN ('Raw', 'Processed')",
                                 "rate_range": "rate BETWEEN 0 AND 1"},
        "data_quality_issue_log": {"rows_not_negative": "affected_rows >= 0"}}
    parts = []
    for table, found in columns.items():
        source = f"({operational[table]})" if table in operational else table
        tests = [("not_null", c, f"count({e})") for c, e in found.items()
                 if not (table == "fact_inquiry" and c in OPTIONAL)]
        tests += [("domain", name, f"count(*) FILTER (WHERE coalesce({test}, TRUE))")
                  for name, test in domain.get(table, {}).items()]
        key = PRIMARY[table]
        tests.append(("primary_key", ", ".join(key), f"count(DISTINCT ({', '.join(key)}))"))
        tests += [("reference", c, f"count(*) FILTER (WHERE {c} IS NULL OR {c} IN "
                   f"(SELECT {KEYS[parent]} FROM {parent}))")
                  for c, parent in LINKS.get(table, {}).items()]
        parts += [f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS \"check\", "
                  f"{passed} AS passed, count(*) AS checked FROM {source}"
                  for kind, name, passed in tests]
    return " UNION ALL ".join(parts)


def operations() -> dict[str, str]:
    one = {
        "total_inquiries": "SELECT count(*) FROM fact_inquiry",
        "total_quotes": "SELECT count(*) FROM fact_quote",
        "converted_inquiries": "SELECT count(*) FROM fact_inquiry WHERE conversion_flag",
        "conversion_rate": f"SELECT {rate('conversion_flag')} FROM fact_inquiry",
        "average_sale_value": f"SELECT {mean('price_c', 2)} FROM fact_inquiry",
        "total_accepted_value": f"SELECT {total('price_c', 2)} FROM fact_inquiry",
        "average_quote_spread": f"SELECT {mean('spread_c', 2)} FROM fact_inquiry",
        "average_quote_spread_pct": f"SELECT {mean('pct_u', 4)} FROM fact_inquiry",
        "average_quote_response_hours": f"SELECT {mean('hours_c', 2)} FROM fact_quote",
        "average_fastest_response_hours": f"SELECT {mean('fastest_c', 2)} FROM fact_inquiry",
        "average_quotes_per_inquiry": f"SELECT {mean('quote_count', 0)} FROM fact_inquiry",
        "active_dealers": "SELECT count(*) FROM dim_dealer WHERE active_flag",
        "quote_anomalies": "SELECT count(*) FROM fact_quote WHERE anomaly_flag",
        "quote_anomaly_rate": f"SELECT {rate('anomaly_flag')} FROM fact_quote",
        "raw_data_quality_score":
            f"SELECT {_rate_of('Raw', 'overall_data_quality_score')} FROM dq",
        "processed_data_quality_score":
            f"SELECT {_rate_of('Processed', 'overall_data_quality_score')} FROM dq",
    }
    quality_cards = ", ".join([
        "max(rate) AS data_quality_metric_rate",
        f"{_rate_of('Raw', 'overall_data_quality_score')} AS raw_data_quality_score",
        f"{_rate_of('Processed', 'overall_data_quality_score')} AS data_quality_score",
        *[f"{_rate_of('Processed', m)} AS {m}" for m in (
            "completeness_rate", "validity_rate", "uniqueness_rate",
            "referential_integrity_rate")]])
    sums = ("CAST(sum(raw_records) AS BIGINT) AS raw_records, CAST(sum(clean_records) AS BIGINT)"
            " AS clean_records, CAST(sum(quarantined_records) AS BIGINT) AS rejected_records")
    loaded = "CAST(sum(loaded_records) AS BIGINT) AS loaded_records"
    by_stage = "max(rate) FILTER (WHERE stage = '{}')".format
    ranks = {"metric": "ORDER BY CASE stage WHEN 'Raw' THEN 1 ELSE 2 END"}
    under = "CAST(count(*) FILTER (WHERE conversion_flag AND {0}) AS DOUBLE) * 100 " \
            "/ count(*) FILTER (WHERE {0})"
    referral, social = (under.format(f"lead_source = '{s}'")
                        for s in ("Dealer Referral", "Social Media"))
    older = (f"{mean('pct_u', 4, 'vehicle_age_at_inquiry > 9')} / "
             f"{mean('pct_u', 4, 'vehicle_age_at_inquiry BETWEEN 0 AND 2')}")
    found = {
        "quarantine": ([REJECTS, ACTIONS], """SELECT printf('QR%07d', row_number() OVER (
            ORDER BY t, r, k, record_id)) AS quarantine_id, table_name, record_id, issue_type,
            action, '2026-01-01 00:00:00' AS detected_at, record_payload
            FROM rejects JOIN actions USING (issue_type)"""),
        "issue_log": ([REJECTS, ACTIONS, FIXES, ISSUES], """SELECT printf('DQ%04d',
            row_number() OVER (ORDER BY table_name, issue_type)) AS issue_id, * FROM issues"""),
        "dq_metrics": ([METRICS], "SELECT * FROM dq"),
        "dq_checks_raw": ([METRICS], "SELECT * FROM raw_checks"),
        "run_summary": ([REJECTS, FIXES, RUNS], "SELECT * FROM runs"),
        "checks": ([], load_checks()),
        "constraint_checks": ([], constraints()),
        "calendar_checks": ([], """SELECT 'missing_days' AS check_name,
            date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS failures
            FROM dim_date
            UNION ALL SELECT 'fact_inquiry_outside_calendar', count(*) FROM fact_inquiry
            WHERE inquiry_date NOT BETWEEN (SELECT min(date) FROM dim_date)
              AND (SELECT max(date) FROM dim_date)
            UNION ALL SELECT 'fact_quote_outside_calendar', count(*) FROM fact_quote
            WHERE quote_date NOT BETWEEN (SELECT min(date) FROM dim_date)
              AND (SELECT max(date) FROM dim_date)"""),
        "cross_fact_checks": ([], f"""SELECT *, quotes = quotes_by_inquiry
              AND conversions = accepted_quotes
              AND abs(value_by_inquiry - value_by_quote) <= 0.01 AS reconciles
            FROM (SELECT count(*) AS inquiries, CAST(sum(quote_count) AS BIGINT)
                AS quotes_by_inquiry, count(*) FILTER (WHERE conversion_flag) AS conversions,
                {total('price_c', 2)} AS value_by_inquiry FROM fact_inquiry),
              (SELECT count(*) AS quotes, count(*) FILTER (WHERE accepted_flag)
                AS accepted_quotes, {total('amount_c', 2, 'accepted_flag')} AS value_by_quote
                FROM fact_quote)"""),
        "v5_data_quality_summary": ([METRICS],
                                    "SELECT *, round(rate * 100, 2) AS rate_percent FROM dq"),
        "q20": ([METRICS], f"""SELECT stage, metric_name, passed_records, total_records,
            round(rate * 100, 2) AS rate_percent, round((rate - lag(rate) OVER (
              PARTITION BY metric_name {ranks['metric']})) * 100, 2)
            AS improvement_percentage_points FROM dq"""),
        "d10": ([REJECTS, ACTIONS, FIXES, ISSUES], """SELECT l.table_name, l.issue_type,
            l.affected_rows, l.action, count(q.record_id) AS quarantined_rows FROM issues l
            LEFT JOIN rejects q ON q.table_name = l.table_name AND q.issue_type = l.issue_type
            GROUP BY 1, 2, 3, 4"""),
        "e01_kpis": ([METRICS], " UNION ALL ".join(
            f"SELECT '{n}' AS metric_name, round(CAST(({q}) AS DOUBLE), 8) AS value"
            for n, q in one.items())),
        "x04_quality_recomputed": ([METRICS], """SELECT stage, metric_name,
            CASE metric_name WHEN 'completeness_rate' THEN 'Completeness Rate'
              WHEN 'validity_rate' THEN 'Validity Rate'
              WHEN 'uniqueness_rate' THEN 'Uniqueness Rate'
              WHEN 'referential_integrity_rate' THEN 'Referential Integrity Rate'
              ELSE 'Overall Data Quality Score' END AS metric,
            passed_records, total_records, rate FROM dq"""),
        "x05_field_profile": ([], profile()),
        "x06_headline_decisions": ([], f"""
            SELECT 'Dealer response SLA' AS decision, printf('<8h conversion %.2f%% vs %.2f%%',
              {under.format('fastest_c < 800')}, {under.format('fastest_c >= 800')}) AS finding
              FROM fact_inquiry
            UNION ALL SELECT 'Channel allocation', printf('Dealer Referral leads Social Media '
              || 'by %.2f pp', {referral} - {social}) FROM fact_inquiry
            UNION ALL SELECT 'Older-vehicle pricing', printf('10+ year relative quote spread is '
              || '%.2fx the 0-2 year spread', {older}) FROM fact_inquiry
            UNION ALL SELECT 'Pricing exceptions', format('{{:,}}', count(*))
              || ' soft anomalies remain reviewable' FROM fact_quote WHERE anomaly_flag"""),
        "measure_quality": ([REJECTS, ACTIONS, FIXES, ISSUES, METRICS, RUNS], f"""
            SELECT * FROM (SELECT {quality_cards} FROM dq),
            (SELECT CAST(sum(affected_rows) AS BIGINT) AS affected_rows FROM issues),
            (SELECT {sums}, {loaded} FROM runs)"""),
        "r17": ([REJECTS, FIXES, RUNS], f"SELECT {PIPELINE_STAGE} AS pipeline_stage, {sums} "
                                        "FROM runs GROUP BY 1"),
        "r18": ([METRICS], f"""SELECT {METRIC_LABEL} AS metric_label,
            {by_stage('Raw')} AS raw_data_quality_rate,
            {by_stage('Processed')} AS processed_data_quality_rate,
            ({by_stage('Processed')} - {by_stage('Raw')}) * 100 AS data_quality_improvement
            FROM dq GROUP BY 1"""),
        "r19": ([REJECTS, FIXES, RUNS], f"SELECT {PIPELINE_STAGE} AS pipeline_stage, "
                                        f"load_status, {sums}, {loaded} FROM runs "
                                        "GROUP BY 1, 2"),
        "r20": ([REJECTS, ACTIONS, FIXES, ISSUES], f"SELECT {CATEGORY} AS issue_category, "
                "CAST(sum(affected_rows) AS BIGINT) AS affected_rows FROM issues GROUP BY 1"),
    }
    found["schema_constraints"] = (
        [REJECTS, ACTIONS, FIXES, ISSUES, METRICS, RUNS], schema_constraints({
            "data_quality_metrics": "SELECT * FROM dq",
            "data_quality_issue_log": found["issue_log"][1],
            "quarantined_records": found["quarantine"][1],
            "pipeline_run_summary": "SELECT * FROM runs"}))
    found["raw_copied_customers"] = ([], """SELECT customer_id, CASE WHEN copy = 1 THEN 'ZZ'
        WHEN balance BETWEEN 0 AND 150 THEN '  ' ELSE lower(n_name) END AS canton
        FROM raw_customer WHERE customer_id IN (SELECT customer_id FROM raw_customer
          GROUP BY customer_id HAVING count(*) > 1)""")
    found["raw_first_customers"] = ([], """SELECT customer_id, raw_lead AS lead_source
        FROM tagged_customer WHERE rn = 1""")
    found["quote_totals"] = ([], """SELECT inquiry_id, any_value(inquiry_date) AS inquiry_date,
        count(q.quote_id) AS quotes, max(q.quote_date) AS latest_quote
        FROM fact_inquiry LEFT JOIN fact_quote q USING (inquiry_id) GROUP BY 1""")
    found["catalogued_vehicles"] = ([], """SELECT vehicle_id, lower(brand) AS brand
        FROM dim_vehicle""")
    found["customer_regions"] = ([], """SELECT customer_id, canton, r_name AS customer_region
        FROM dim_customer LEFT JOIN nation ON canton = upper(n_name)
        LEFT JOIN region ON n_regionkey = r_regionkey""")
    found["top_most_quoted_inquiries"] = ([], """SELECT lead_source, inquiry_id, quote_count
        FROM (SELECT *, rank() OVER (PARTITION BY lead_source ORDER BY quote_count DESC) AS place
              FROM fact_inquiry WHERE quote_count IS NOT NULL) WHERE place <= 50""")
    found["top_highest_quotes"] = ([], f"""SELECT quote_id, inquiry_id,
        {units('amount_c', 2)} AS quote_amount
        FROM (SELECT *, rank() OVER (ORDER BY amount_c DESC) AS place FROM fact_quote)
        WHERE place <= 100""")
    found["sketched_response_percentiles"] = ([], """SELECT lead_source, count(*) AS inquiries,
        TRUE AS median_within, TRUE AS p90_within, quantile_cont(fastest_c, 0.5) / 100
        AS median_hours FROM fact_inquiry WHERE fastest_c IS NOT NULL GROUP BY 1""")
    return {name: with_base(*ctes) + select for name, (ctes, select) in found.items()}


