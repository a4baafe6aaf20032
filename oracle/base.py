"""Shared SQL: exact rounding in whole numbers, and the cleaned tables as CTEs.

Money, hours and ratios are kept as whole units (`_c` hundredths, `_u` ten-thousandths), so
sums and halves are exact.
"""

from __future__ import annotations


def div_up(top: str, bottom: str, digits: int) -> str:
    """top / bottom rounded half away from zero, as DOUBLE."""
    t, b = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    return (f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST(sign({t}) * sign({b}) * "
            f"((2 * abs({t}) * {10 ** digits} + abs({b})) // (2 * abs({b}))) AS DOUBLE) "
            f"/ {10 ** digits} END)")


def div_even(top: str, bottom: str, digits: int) -> str:
    """Non-negative top / bottom in units of 10^-digits, rounded half to even, as BIGINT."""
    t, b = f"(CAST({top} AS HUGEINT) * {10 ** digits})", f"CAST({bottom} AS HUGEINT)"
    return (f"CAST({t} // {b} + CASE WHEN 2 * ({t} % {b}) > {b} OR (2 * ({t} % {b}) = {b} "
            f"AND ({t} // {b}) % 2 = 1) THEN 1 ELSE 0 END AS BIGINT)")


def mean_up(column: str, scale: int, digits: int, where: str | None = None,
            factor: int = 1) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return div_up(f"(SUM({column}){f} * {factor})", f"(COUNT({column}){f} * {10 ** scale})", digits)


def mean(column: str, scale: int, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"(CAST(SUM({column}){f} AS DOUBLE) / {10 ** scale} / COUNT({column}){f})"


def total(column: str, scale: int, where: str | None = None, zero: bool = False) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    text = f"CAST(SUM({column}){f} AS DOUBLE) / {10 ** scale}"
    return f"coalesce({text}, 0)" if zero else f"({text})"


def rate_up(flag: str, digits: int = 4) -> str:
    return div_up(f"COUNT(*) FILTER (WHERE {flag})", f"COUNT({flag})", digits)


def rate(flag: str) -> str:
    return f"(CAST(COUNT(*) FILTER (WHERE {flag}) AS DOUBLE) / COUNT({flag}))"


def units(column: str, scale: int) -> str:
    return f"(CAST({column} AS DOUBLE) / {10 ** scale})"


def percentile_units(table: str, keys: list[str], column: str,
                     fractions: dict[str, tuple[int, int]]) -> str:
    """SELECT of the interpolated percentiles, each as `<name>_t` over `<name>_b` units."""
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    head = "".join(f"{k}, " for k in keys)
    picks = []
    for name, (top, bottom) in fractions.items():
        lo = f"max(v) FILTER (WHERE rn = ((n - 1) * {top}) // {bottom})"
        hi = (f"max(v) FILTER (WHERE rn = ((n - 1) * {top}) // {bottom} + "
              f"CASE WHEN ((n - 1) * {top}) % {bottom} > 0 THEN 1 ELSE 0 END)")
        rest = f"((max(n) - 1) * {top}) % {bottom}"
        picks.append(f"{lo} * {bottom} + ({hi} - {lo}) * ({rest}) AS {name}_t, "
                     f"{bottom} AS {name}_b")
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return (f"SELECT {head}max(n) AS n, {', '.join(picks)} FROM (SELECT {head}{column} AS v, "
            f"row_number() OVER ({part} ORDER BY {column}) - 1 AS rn, "
            f"count(*) OVER ({part}) AS n FROM {table} WHERE {column} IS NOT NULL){group}")


RATING_C = "CAST(sign(b) * ((2 * abs(b) + 2100) // 4200) AS BIGINT)"

BASE = f"""
lines AS MATERIALIZED (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS price_c,
    CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS BIGINT) AS hours_c,
    CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(4,2)) AS tax,
    CAST(l_shipdate AS DATE) AS ship_day
  FROM lineitem),
line_ranks AS MATERIALIZED (
  SELECT *,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, ship_day, l_partkey,
      l_suppkey, price_c) AS first_rn,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY price_c DESC, l_linenumber DESC,
      ship_day DESC, l_partkey DESC, l_suppkey DESC) AS best_rn,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship_day, l_partkey,
      l_suppkey, price_c) AS copy_rn
  FROM lines),
raw_customer AS (
  SELECT 'C' || c_custkey AS customer_id, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
    c_nationkey, n_name, n_regionkey, c_mktsegment, k.copy
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey, (VALUES (0), (1)) AS k(copy)
  WHERE k.copy = 0 OR CAST(c_acctbal AS DECIMAL(12,2)) > 9800),
tagged_customer AS MATERIALIZED (
  SELECT *, CASE WHEN balance >= -950
      THEN DATE '1994-06-01' + CAST(floor(balance / 20) AS INTEGER) END AS created,
    row_number() OVER (PARTITION BY customer_id ORDER BY copy) AS rn,
    (ARRAY['Organic Search', ' paid search', 'Dealer Referral', 'SOCIAL MEDIA', 'Direct',
      'partner ', 'billboard'])[c_nationkey % 7 + 1] AS raw_lead,
    (ARRAY['Organic Search', 'Paid Search', 'Dealer Referral', 'Social Media', 'Direct',
      'Partner', NULL])[c_nationkey % 7 + 1] AS lead
  FROM raw_customer),
dim_customer AS MATERIALIZED (
  SELECT customer_id, CAST(created AS DATE) AS customer_created_date,
    CASE WHEN balance < 1500 THEN '18-24' WHEN balance < 4000 THEN '25-34'
      WHEN balance < 6500 THEN '35-44' WHEN balance < 9000 THEN '45-64'
      ELSE '65+ Years' END AS age_group,
    CASE WHEN copy = 1 THEN 'ZZ' WHEN balance BETWEEN 0 AND 150 THEN 'Unknown'
      ELSE upper(n_name) END AS canton,
    upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS customer_type,
    (ARRAY['Email', 'Phone', 'Text Message', 'In-Person', 'Email'])[n_regionkey + 1]
      AS preferred_contact_method, lead AS lead_source
  FROM tagged_customer WHERE rn = 1 AND created IS NOT NULL),
tagged_vehicle AS MATERIALIZED (
  SELECT 'V' || p_partkey AS vehicle_id, p_brand AS brand, p_name AS model,
    upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS vehicle_type,
    CASE WHEN p_size = 25 OR (p_type = 'PROMO' AND p_size < 10) THEN 'Unknown'
      ELSE (ARRAY['Petrol', 'Diesel', 'Hybrid', 'Electric', 'Petrol'])[p_size % 5 + 1]
      END AS fuel_type,
    p_type = 'PROMO' AND p_size < 10 AND p_size <> 25 AS raw_fuel_missing,
    CASE WHEN p_size = 49 THEN 1989 ELSE 1990 + p_partkey % 6 END AS manufacture_year,
    p_size * 10600 - 20000 AS raw_km, abs(p_size * 10600 - 20000) AS mileage_km,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) * (p_size * 2 + 6) AS value_c,
    CASE WHEN p_size < 13 THEN 'Excellent' WHEN p_size < 26 THEN 'Good'
      WHEN p_size < 38 THEN 'Fair' ELSE 'Poor' END AS vehicle_condition
  FROM part),
dim_vehicle AS MATERIALIZED (
  SELECT vehicle_id, brand, model, vehicle_type, fuel_type, manufacture_year, mileage_km,
    value_c, vehicle_condition,
    CASE WHEN mileage_km <= 25000 THEN '0-25k' WHEN mileage_km <= 75000 THEN '25k-75k'
      WHEN mileage_km <= 125000 THEN '75k-125k' WHEN mileage_km <= 200000 THEN '125k-200k'
      ELSE '200k+' END AS mileage_bracket,
    CASE WHEN value_c < 1000000 THEN '<10k' WHEN value_c < 2500000 THEN '10k-25k'
      WHEN value_c < 5000000 THEN '25k-50k' WHEN value_c < 8000000 THEN '50k-80k'
      ELSE '80k+' END AS market_value_band
  FROM tagged_vehicle
  WHERE mileage_km <= 500000 AND value_c > 0 AND manufacture_year BETWEEN 1990 AND 2025),
raw_dealer AS (
  SELECT *, CAST(balance * 100 AS BIGINT) + 90000 AS b FROM (
    SELECT 'D' || s_suppkey AS dealer_id, s_name, r_name, s_nationkey, k.copy,
      CAST(s_acctbal AS DECIMAL(12,2)) AS balance
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1)) AS k(copy))
  WHERE copy = 0 OR balance BETWEEN 4000 AND 4200),
tagged_dealer AS MATERIALIZED (
  SELECT *, {RATING_C} AS rating_c,
    row_number() OVER (PARTITION BY dealer_id ORDER BY copy) AS rn FROM raw_dealer),
dim_dealer AS MATERIALIZED (
  SELECT dealer_id, s_name AS dealer_name, r_name AS dealer_region,
    (ARRAY['Franchise', 'Independent', 'Broker'])[s_nationkey % 3 + 1] AS dealer_type,
    rating_c, balance >= 500 AS active_flag
  FROM tagged_dealer WHERE rn = 1 AND rating_c BETWEEN 0 AND 500),
raw_inquiry AS (
  SELECT 'I' || o_orderkey AS inquiry_id, 'C' || o_custkey AS customer_id,
    'V' || f.l_partkey AS vehicle_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
    CAST(o_orderdate AS DATE) AS order_day, o_orderstatus, o_orderpriority, k.copy,
    b.l_suppkey AS best_dealer, b.ship_day AS best_day, b.price_c AS best_price_c
  FROM orders
    LEFT JOIN line_ranks f ON f.l_orderkey = o_orderkey AND f.first_rn = 1
    LEFT JOIN line_ranks b ON b.l_orderkey = o_orderkey AND b.best_rn = 1,
    (VALUES (0), (1)) AS k(copy)
  WHERE k.copy = 0 OR CAST(o_totalprice AS DECIMAL(12,2)) > 495000),
tagged_inquiry AS MATERIALIZED (
  SELECT *, CASE
      WHEN rn > 1 THEN 'duplicate_primary_key'
      WHEN inquiry_date IS NULL THEN 'malformed_inquiry_date'
      WHEN customer_known IS NULL OR (vehicle_id IS NOT NULL AND value_c IS NULL)
        THEN 'invalid_inquiry_foreign_key'
      WHEN inquiry_date < created THEN 'customer_date_sequence' END AS rule
  FROM (
    SELECT i.*, CASE WHEN amount >= 6000 THEN order_day END AS inquiry_date,
      row_number() OVER (PARTITION BY inquiry_id ORDER BY copy) AS rn,
      c.customer_created_date AS created, c.customer_id AS customer_known, v.value_c,
      v.manufacture_year,
      CASE WHEN o_orderstatus = 'F' AND amount > 450000 THEN 'D-9999'
        WHEN o_orderstatus = 'F' THEN 'D' || best_dealer END AS raw_winner,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Dealer Referral'
        WHEN '2-HIGH' THEN 'Social Media' WHEN '3-MEDIUM' THEN 'Organic Search'
        WHEN '4-NOT SPECIFIED' THEN 'Paid Search' WHEN '5-LOW' THEN 'Direct'
        END AS lead_source,
      CASE WHEN copy = 1 THEN 'Open' WHEN o_orderstatus = 'P' AND amount > 400000
        THEN 'Expired' WHEN o_orderstatus = 'P' THEN 'Lost' WHEN o_orderstatus = 'O' THEN 'Open'
        ELSE 'Converted' END AS raw_status
    FROM raw_inquiry i LEFT JOIN dim_customer c USING (customer_id)
      LEFT JOIN dim_vehicle v USING (vehicle_id))),
raw_quote AS (
  SELECT 'Q' || l_orderkey || '-' || l_linenumber AS quote_id,
    'I' || l_orderkey AS inquiry_id, 'D' || l_suppkey AS dealer_id, l_returnflag,
    CASE WHEN NOT (hours_c = 5000 AND tax = 0) THEN ship_day END AS quote_date,
    CASE WHEN discount = 0.10 AND tax = 0.08 THEN -100
      WHEN discount = 0 AND tax = 0 THEN 999999900 ELSE price_c END AS amount_c,
    CASE WHEN discount <> 0 THEN hours_c END AS hours_c, copy_rn, ship_day, l_partkey,
    l_suppkey, price_c, l_linenumber, best_rn = 1 AND o_orderstatus = 'F' AS accepted
  FROM line_ranks LEFT JOIN orders ON o_orderkey = l_orderkey),
tagged_quote AS MATERIALIZED (
  SELECT q.*, CASE
      WHEN copy_rn > 1 THEN 'duplicate_primary_key'
      WHEN quote_date IS NULL OR amount_c <= 0 OR amount_c > 50000000
        THEN 'invalid_quote_domain'
      WHEN i.inquiry_id IS NULL OR d.dealer_id IS NULL THEN 'invalid_quote_foreign_key'
      WHEN quote_date < i.inquiry_date THEN 'quote_date_sequence' END AS rule
  FROM raw_quote q
    LEFT JOIN (SELECT inquiry_id, inquiry_date FROM tagged_inquiry WHERE rule IS NULL) i
      ON i.inquiry_id = q.inquiry_id
    LEFT JOIN dim_dealer d ON d.dealer_id = q.dealer_id),
dealer_median AS (
  SELECT dealer_id, quantile_cont(CAST(hours_c AS DOUBLE), 0.5) AS m FROM tagged_quote
  WHERE rule IS NULL GROUP BY dealer_id),
filled_quote AS MATERIALIZED (
  SELECT q.* EXCLUDE (hours_c), hours_c IS NULL AS imputed,
    CAST(coalesce(hours_c, m, (SELECT quantile_cont(CAST(hours_c AS DOUBLE), 0.5)
      FROM tagged_quote WHERE rule IS NULL)) AS BIGINT) AS hours_c
  FROM tagged_quote q LEFT JOIN dealer_median USING (dealer_id) WHERE rule IS NULL),
reconciled AS MATERIALIZED (
  SELECT i.*, s.n AS quote_count, s.high_c, s.low_c, s.avg_c, s.fastest_c,
    w.dealer_id AS won_dealer, w.amount_c AS won_c,
    o_orderstatus = 'F' AND coalesce(s.wins, 0) <> 1 AS downgraded,
    o_orderstatus = 'F' AND coalesce(s.wins, 0) = 1 AS conversion_flag
  FROM tagged_inquiry i
    LEFT JOIN (SELECT inquiry_id, count(*) AS n, max(amount_c) AS high_c,
        min(amount_c) AS low_c, min(hours_c) AS fastest_c,
        count(*) FILTER (WHERE accepted) AS wins,
        {div_even("sum(amount_c)", "count(*) * 100", 2)} AS avg_c
      FROM filled_quote GROUP BY inquiry_id) s USING (inquiry_id)
    LEFT JOIN (SELECT * FROM filled_quote WHERE accepted) w USING (inquiry_id)
  WHERE i.rule IS NULL),
fact_inquiry AS MATERIALIZED (
  SELECT inquiry_id, customer_id, vehicle_id, inquiry_date, lead_source,
    CASE WHEN downgraded THEN 'Lost' ELSE raw_status END AS status,
    CASE WHEN conversion_flag THEN won_c END AS price_c,
    CASE WHEN conversion_flag THEN won_dealer END AS winning_dealer_id, conversion_flag,
    CASE WHEN conversion_flag THEN abs(date_diff('day', order_day, best_day)) END
      AS days_to_conversion, quote_count, high_c, low_c, avg_c, fastest_c,
    high_c - low_c AS spread_c, {div_even("(high_c - low_c)", "low_c", 4)} AS pct_u,
    year(inquiry_date) - manufacture_year AS vehicle_age_at_inquiry, value_c
  FROM reconciled WHERE quote_count IS NOT NULL),
fact_quote AS MATERIALIZED (
  SELECT *, ratio_u NOT BETWEEN 7000 AND 10800 AS anomaly_flag FROM (
    SELECT q.quote_id, q.inquiry_id, q.dealer_id, q.quote_date, q.amount_c, q.hours_c,
      row_number() OVER (PARTITION BY q.inquiry_id ORDER BY q.amount_c DESC, q.ship_day,
        q.l_partkey, q.l_suppkey, q.price_c) AS quote_rank,
      q.accepted AND i.conversion_flag AS accepted_flag, i.value_c,
      {div_even("q.amount_c", "i.value_c", 4)} AS ratio_u, q.imputed,
      q.accepted AND NOT i.conversion_flag AS cleared
    FROM filled_quote q JOIN fact_inquiry i USING (inquiry_id))),
dim_date AS MATERIALIZED (
  SELECT CAST(unnest(generate_series(make_date(year(low), 1, 1), make_date(year(high), 12, 31),
    INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT least(min(o_orderdate), (SELECT min(l_shipdate) FROM lineitem)) AS low,
    greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem)) AS high FROM orders))
"""

DEALER_PERFORMANCE = f"""
vw_dealer AS (
  SELECT d.dealer_id, d.dealer_name, d.dealer_region, d.dealer_type,
    {units("d.rating_c", 2)} AS dealer_rating, d.active_flag, count(q.quote_id) AS total_quotes,
    count(q.quote_id) FILTER (WHERE q.accepted_flag) AS accepted_quotes,
    {div_up("count(q.quote_id) FILTER (WHERE q.accepted_flag)", "count(q.quote_id)", 4)}
      AS dealer_win_rate,
    {mean_up("q.hours_c", 2, 2)} AS average_response_time_hours,
    {mean_up("q.ratio_u", 4, 4)} AS average_quote_to_market_ratio,
    {total("q.amount_c", 2, "q.accepted_flag")} AS accepted_quote_value
  FROM dim_dealer d LEFT JOIN fact_quote q ON q.dealer_id = d.dealer_id
  GROUP BY ALL)
"""


def with_base(*more: str) -> str:
    """WITH clause of the cleaned tables and further CTEs; a SELECT follows."""
    return "WITH " + ",\n".join([BASE.strip(), *[m.strip() for m in more]]) + "\n"
