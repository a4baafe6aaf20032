"""Quarantine, issue log, quality scores, run summary and load checks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions import numbers as N
from marketlens.functions.ordinals import source_key
from marketlens.operators.checks import Reference, Unique, key_results
from marketlens.operators.joins import compare_by_key
from marketlens.operators.numbering import range_numbered
from marketlens.operators.rules import passed_counts
from marketlens.plans.clean import Cleaned, known_issues, with_payload
from marketlens.schema import (
    ASSESSMENT_DATE, CORRECTIONS, DETECTED_AT, DIMENSION_TEXT, KEYS, MALFORMED_ACTION,
    MALFORMED_RULE, REJECT_RULES,
    REQUIRED_COLUMNS,
)
from marketlens.session import Workspace

TABLE_ORDER = ["dim_customer", "dim_vehicle", "dim_dealer", "fact_inquiry", "fact_quote",
               "dim_date"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _lookup_literal(words: dict[str, str], column: str):
    pairs = [F.lit(item) for pair in words.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


def _rejects(cleaned: Cleaned) -> DataFrame:
    """All rejected rows without their original rows."""
    parts = []
    for table in TABLE_ORDER:
        for rows in cleaned.rejects[table]:
            parts.append(rows.select(F.lit(table).alias("table_name"), *_reject_columns(table)))
    return _union(parts)


def _actions(table: str) -> dict[str, str]:
    return {MALFORMED_RULE: MALFORMED_ACTION, **REJECT_RULES[table]}


def _reject_columns(table: str) -> list[Column]:
    return [F.coalesce(F.col(KEYS[table]).cast("string"), F.lit("<NULL>")).alias("record_id"),
            F.col("_rule").alias("issue_type"),
            _lookup_literal(_actions(table), "_rule").alias("action")]


def _numbered_rejects(cleaned: Cleaned, workspace: Workspace, table: str) -> DataFrame:
    """The whole rejects of a table, numbered by rule and source order.

    Rows of one table compare by their own ordinals; only frames of different ordinals need
    `source_key`.
    """
    frames = [with_payload(rows, cleaned.origins[table], table) if "_payload" not in rows.columns
              else rows for rows in cleaned.rejects[table]]
    alike = len({rows.schema["_ordinal"].dataType.simpleString() for rows in frames}) == 1
    place = F.array_position(F.array(*[F.lit(r) for r in _actions(table)]), F.col("_rule"))
    whole = _union([rows.select(
        *_reject_columns(table), F.col("_payload").alias("record_payload"),
        place.cast("int").alias("_place"),
        (F.col("_ordinal") if alike else source_key(rows)).alias("_source_order"))
        for rows in frames])
    order = [F.col("_place"), F.col("_source_order"), F.col("record_id")]
    return range_numbered(workspace, whole, f"quarantine_{table}", order, "_n").drop(
        "_place", "_source_order").withColumn("table_name", F.lit(table))


def quarantined_records(cleaned: Cleaned, workspace: Workspace) -> DataFrame:
    """Every rejected row with its original values and a consecutive identifier.

    Tables and rules come in the order they were applied, rows of a rule in source order. Rejects
    are unbounded, so those of a table are numbered by range slices instead of one global window,
    and go on from the last number of the table before.
    """
    with ThreadPoolExecutor(len(TABLE_ORDER)) as pool:
        parts = list(pool.map(lambda t: _numbered_rejects(cleaned, workspace, t), TABLE_ORDER))
        sizes = list(pool.map(lambda part: part.count(), parts))
    earlier = [sum(sizes[:i]) for i in range(len(parts))]
    numbered = _union([part.withColumn("_n", F.col("_n") + F.lit(before).cast("int"))
                       for part, before in zip(parts, earlier)])
    return numbered.select(
        F.format_string("QR%07d", "_n").alias("quarantine_id"), "table_name", "record_id",
        "issue_type", "action", F.to_timestamp(F.lit(DETECTED_AT)).alias("detected_at"),
        "record_payload")


def issue_counts(cleaned: Cleaned) -> DataFrame:
    """(table, issue, rows, action, result): one aggregate per tagged table."""
    parts = []
    for table in TABLE_ORDER:
        notes = known_issues(table)
        for tagged in cleaned.tagged[table]:
            fixes = [name[5:] for name in tagged.columns if name.startswith("_fix_")]
            if fixes:
                wide = tagged.agg(*[N.count_where(F.col(f"_fix_{n}")).alias(n) for n in fixes])
                entries = F.explode(F.array(*[F.struct(
                    F.lit(n).alias("issue_type"), F.col(n).alias("affected_rows"),
                    F.lit(notes[n][0]).alias("action"), F.lit(notes[n][1]).alias("final_result"))
                    for n in fixes]))
                parts.append(wide.select(entries.alias("e")).select(
                    F.lit(table).alias("table_name"), "e.*"))
    rejects = _rejects(cleaned).groupBy("table_name", "issue_type", "action").agg(
        N.rows().alias("affected_rows"))
    parts.append(rejects.select(
        "table_name", "issue_type", "affected_rows", "action",
        F.concat(F.format_number("affected_rows", 0),
                 F.lit(" row(s) excluded from the curated layer")).alias("final_result")))
    return _union(parts).filter("affected_rows > 0")


def issue_log(counts: DataFrame) -> DataFrame:
    """Issue counts with identifiers; one row per rule, so the window is a few dozen rows."""
    grouped = counts.groupBy("table_name", "issue_type", "action", "final_result").agg(
        F.sum("affected_rows").alias("affected_rows"))
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("table_name", "issue_type"))
    return grouped.select(
        F.format_string("DQ%04d", number).alias("issue_id"), "table_name", "issue_type",
        "affected_rows", "action", "final_result")


# --- quality scores ------------------------------------------------------------------------

VALIDITY = {
    "dim_vehicle": {
        "mileage": N.valid_mileage, "market_value": lambda c: N.above(c, 0),
        "year": N.valid_year,
    },
    "dim_dealer": {"rating": N.valid_rating},
    "fact_inquiry": {"inquiry_date": lambda c: N.to_day(c).isNotNull()},
    "fact_quote": {
        "amount": N.valid_quote_amount, "quote_date": lambda c: N.to_day(c).isNotNull(),
        "response": lambda c: N.at_or_above(c, 0),
    },
}
VALIDITY_COLUMNS = {
    "mileage": "mileage_km", "market_value": "estimated_market_value",
    "year": "manufacture_year", "rating": "dealer_rating", "inquiry_date": "inquiry_date",
    "amount": "quote_amount", "quote_date": "quote_date", "response": "response_time_hours",
}


def field_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Completeness and validity (metric_name, check, passed, checked), one pass per table."""
    parts = []
    for table, required in REQUIRED_COLUMNS.items():
        checks = {f"completeness_rate:{c}": F.col(c).isNotNull() for c in required}
        checks |= {f"validity_rate:{name}": rule(VALIDITY_COLUMNS[name])
                   for name, rule in VALIDITY.get(table, {}).items()}
        parts.append(passed_counts(tables[table], checks))
    return _union(parts).withColumns({
        "metric_name": F.substring_index("check", ":", 1),
        "check": F.substring_index("check", ":", -1)})


FOREIGN_KEYS = [
    ("fact_inquiry", "customer_id", "dim_customer", "customer_id"),
    ("fact_inquiry", "vehicle_id", "dim_vehicle", "vehicle_id"),
    ("fact_quote", "inquiry_id", "fact_inquiry", "inquiry_id"),
    ("fact_quote", "dealer_id", "dim_dealer", "dealer_id"),
    ("fact_inquiry", "winning_dealer_id", "dim_dealer", "dealer_id"),
]


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Uniqueness and integrity of all keys, from one scan per table and one shuffle."""
    found = key_results(
        tables, [Unique(key, table, (key,)) for table, key in KEYS.items()],
        [Reference(f"{child}.{foreign}", child, (foreign,), parent, (key,))
         for child, foreign, parent, key in FOREIGN_KEYS])
    return found.withColumn("metric_name", F.when(
        F.col("kind") == "unique", "uniqueness_rate").otherwise("referential_integrity_rate")) \
        .drop("kind")


def dimension_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every single check of the four quality dimensions of one table set."""
    return _union([field_checks(tables), key_checks(tables)])


def quality_metrics(raw: dict[str, DataFrame], curated: dict[str, DataFrame]) -> DataFrame:
    """Four dimensions and the check-weighted overall score, before and after cleaning."""
    checks = _union([
        dimension_checks(tables).withColumn("stage", F.lit(stage))
        for stage, tables in (("Raw", raw), ("Processed", curated))])
    names = F.array(F.col("metric_name"), F.lit("overall_data_quality_score"))
    scored = checks.withColumn("metric_name", F.explode(names)).groupBy(
        "metric_name", "stage").agg(
        F.sum("passed").alias("passed_records"), F.sum("checked").alias("total_records"))
    return scored.select(
        "metric_name", "stage", "passed_records", "total_records",
        N.bounded_rate(F.col("passed_records"), F.col("total_records")).alias("rate"),
        _lookup_literal(DIMENSION_TEXT, "metric_name").alias("description"),
        F.to_date(F.lit(ASSESSMENT_DATE)).alias("assessment_date"))


def run_summary(raw: dict[str, DataFrame], cleaned: Cleaned, counts: DataFrame) -> DataFrame:
    """Raw, duplicate, corrected, rejected and clean rows per table."""
    sizes = _union([
        raw[t].agg(F.lit(t).alias("table_name"), N.rows().alias("raw_records"))
        for t in TABLE_ORDER])
    clean = _union([
        cleaned.curated[t].agg(F.lit(t).alias("table_name"), N.rows().alias("clean_records"))
        for t in TABLE_ORDER])
    corrections = [name for issues in CORRECTIONS.values() for name in issues]
    issues = counts.groupBy("table_name").agg(
        N.total("affected_rows", F.col("issue_type") == "duplicate_primary_key")
        .alias("duplicate_records"),
        N.total("affected_rows", F.col("issue_type").isin(corrections))
        .alias("corrected_records"))
    rejects = _rejects(cleaned).groupBy("table_name").agg(
        F.count_distinct("record_id").alias("quarantined_records"))
    return (sizes.join(issues, "table_name", "left").join(rejects, "table_name", "left")
            .join(clean, "table_name", "left")
            .select("table_name", "raw_records",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in (
                        "duplicate_records", "corrected_records", "quarantined_records",
                        "clean_records")],
                    F.lit(0).cast("bigint").alias("loaded_records"),
                    F.lit("Ready").alias("load_status")))


def stamp_loaded(summary: DataFrame) -> DataFrame:
    """The run summary as it stands after a successful load."""
    return summary.withColumns({"loaded_records": F.col("clean_records"),
                                "load_status": F.lit("Loaded")})


# --- business rules and load checks ----------------------------------------------------------

def accepted_quote_violations(inquiries: DataFrame, quotes: DataFrame) -> DataFrame:
    """Inquiries without exactly one accepted quote by their winner, or lost with one."""
    accepted = quotes.filter("accepted_flag").groupBy("inquiry_id").agg(
        N.rows().alias("accepted_count"), F.min("dealer_id").alias("accepted_dealer_id"))
    df = inquiries.select("inquiry_id", "conversion_flag", "winning_dealer_id").join(
        accepted, "inquiry_id", "left").withColumn(
        "accepted_count", F.coalesce("accepted_count", F.lit(0)))
    converted = F.col("conversion_flag")
    wrong_count = F.when(converted, F.col("accepted_count") != 1).otherwise(
        F.col("accepted_count") != 0)
    wrong_winner = converted & ~F.col("winning_dealer_id").eqNullSafe(F.col("accepted_dealer_id"))
    return df.filter(wrong_count | wrong_winner)


def _summary_mismatches(inquiries: DataFrame, quotes: DataFrame) -> DataFrame:
    """Stored quote summaries that a recomputation by key does not confirm."""
    again = quotes.groupBy("inquiry_id").agg(
        N.rows().alias("quote_count"), F.max("quote_amount").alias("highest_quote"),
        F.min("quote_amount").alias("lowest_quote"),
        N.ratio(F.sum("quote_amount"), N.rows()).alias("average_quote"),
        F.min("response_time_hours").alias("fastest_response_hours"))
    return compare_by_key(inquiries, again, "inquiry_id", {
        "quote_count": 0, "highest_quote": 0, "lowest_quote": 0, "average_quote": 0.01,
        "fastest_response_hours": 0.01})


def _price_mismatches(inquiries: DataFrame, quotes: DataFrame) -> DataFrame:
    accepted = quotes.filter("accepted_flag").groupBy("inquiry_id").agg(
        F.min("quote_amount").alias("accepted_amount"))
    gap = F.abs(F.col("final_sale_price") - F.col("accepted_amount"))
    return (inquiries.filter("conversion_flag").select("inquiry_id", "final_sale_price")
            .join(accepted, "inquiry_id", "left")
            .filter(F.coalesce(gap > 0.01, F.lit(True))))


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """The 22 load assertions as (check_name, failures); each is a distributed aggregate."""
    inquiries, quotes = tables["fact_inquiry"], tables["fact_quote"]
    named = {"dim_customer": "customer_id", "dim_vehicle": "vehicle_id",
             "dim_dealer": "dealer_id", "fact_inquiry": "inquiry_id", "fact_quote": "quote_id",
             "dim_date": "date"}
    domains = {
        "dim_vehicle": {"valid_mileage": N.valid_mileage("mileage_km"),
                        "valid_manufacture_year": N.valid_year("manufacture_year")},
        "dim_dealer": {"valid_dealer_rating": N.valid_rating("dealer_rating")},
        "fact_quote": {"valid_quote_amount": N.valid_quote_amount("quote_amount"),
                       "valid_response_time": N.at_or_above("response_time_hours", 0)},
        "fact_inquiry": {"conversion_status_consistency":
                         (F.col("status") == "Converted") == F.col("conversion_flag")},
    }
    links = {
        "inquiry_customer_fk": ("fact_inquiry", "customer_id", "dim_customer", "customer_id"),
        "inquiry_vehicle_fk": ("fact_inquiry", "vehicle_id", "dim_vehicle", "vehicle_id"),
        "quote_inquiry_fk": ("fact_quote", "inquiry_id", "fact_inquiry", "inquiry_id"),
        "quote_dealer_fk": ("fact_quote", "dealer_id", "dim_dealer", "dealer_id"),
        "inquiry_date_fk": ("fact_inquiry", "inquiry_date", "dim_date", "date"),
        "quote_date_fk": ("fact_quote", "quote_date", "dim_date", "date"),
    }
    keyed = key_results(
        tables, [Unique(f"unique_{key}", t, (key,)) for t, key in named.items()],
        [Reference(name, c, (fk,), p, (key,)) for name, (c, fk, p, key) in links.items()])
    parts = [found.select(
        F.col("check").alias("check_name"), (F.col("checked") - F.col("passed")).alias("failures"))
        for found in [keyed.drop("kind"), *[passed_counts(tables[t], rules)
                                            for t, rules in domains.items()]]]
    dated = quotes.select("inquiry_id", "quote_date").join(
        inquiries.select("inquiry_id", "inquiry_date"), "inquiry_id", "left")
    failing = {
        "quote_date_sequence":
            dated.filter(~N.date_sequence(F.col("quote_date"), F.col("inquiry_date"))),
        "accepted_quote_rule": accepted_quote_violations(inquiries, quotes),
        "accepted_value_reconciliation": _price_mismatches(inquiries, quotes),
        "quote_summary_reconciliation": _summary_mismatches(inquiries, quotes),
    }
    parts += [df.agg(F.lit(name).alias("check_name"), N.rows().alias("failures"))
              for name, df in failing.items()]
    return _union([p.select("check_name", F.col("failures").cast("bigint").alias("failures"))
                   for p in parts]).withColumn("passed", F.col("failures") == 0)


def assert_checks(checks: DataFrame) -> None:
    """Raise with the names of the failed checks (at most one row per check)."""
    failed = sorted(r.check_name for r in checks.filter("not passed").collect())
    if failed:
        raise ValueError(f"curated tables break these checks: {failed}")


def constraint_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Column and row constraints of the relational schema as (check, passed, checked)."""
    price, winner = F.col("final_sale_price").isNotNull(), F.col("winning_dealer_id").isNotNull()
    per_table = {
        "dim_date": {"month_range": F.col("month").between(1, 12),
                     "week_range": F.col("week").between(1, 53)},
        "dim_vehicle": {"vehicle_year": N.valid_year("manufacture_year"),
                        "vehicle_mileage": N.valid_mileage("mileage_km"),
                        "vehicle_value": F.col("estimated_market_value") > 0},
        "dim_dealer": {"dealer_rating": N.valid_rating("dealer_rating")},
        "fact_inquiry": {
            "status_domain": F.col("status").isin("Converted", "Lost", "Expired", "Open"),
            "quote_count_positive": F.col("quote_count") > 0,
            "spread_not_negative": F.col("quote_spread") >= 0,
            "spread_pct_not_negative": F.col("quote_spread_pct") >= 0,
            "age_not_negative": F.col("vehicle_age_at_inquiry") >= 0,
            "conversion_consistency": F.when(F.col("conversion_flag"), price & winner)
            .otherwise(~price & ~winner)},
        "fact_quote": {
            "amount_range": N.valid_quote_amount("quote_amount"),
            "hours_not_negative": F.col("response_time_hours") >= 0,
            "rank_positive": F.col("quote_rank") > 0,
            "value_positive": F.col("estimated_market_value") > 0,
            "ratio_positive": F.col("quote_to_market_ratio") > 0},
    }
    twice = (tables["fact_quote"].filter("accepted_flag").groupBy("inquiry_id")
             .agg(N.rows().alias("n")))
    one_winner = passed_counts(twice, {"one_accepted_quote_per_inquiry": F.col("n") <= 1})
    return _union([passed_counts(tables[t], rules) for t, rules in per_table.items()]
                  + [one_winner])


def calendar_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing calendar days and fact dates outside the calendar."""
    days = tables["dim_date"].select("date")
    span = days.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    spine = span.select(F.explode(F.sequence("low", "high")).alias("date"))
    gaps = spine.join(days, "date", "left_anti").agg(
        F.lit("missing_days").alias("check_name"), N.rows().alias("failures"))
    outside = [
        tables[t].crossJoin(F.broadcast(span)).agg(
            F.lit(f"{t}_outside_calendar").alias("check_name"),
            N.count_where(~F.coalesce(F.col(c).between(F.col("low"), F.col("high")),
                                      F.lit(False))).alias("failures"))
        for t, c in (("fact_inquiry", "inquiry_date"), ("fact_quote", "quote_date"))]
    return _union([gaps, *outside])


def cross_fact_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Totals both facts must agree on, side by side in one row."""
    inquiries = tables["fact_inquiry"].agg(
        N.rows().alias("inquiries"), N.total("quote_count").alias("quotes_by_inquiry"),
        N.count_where(F.col("conversion_flag")).alias("conversions"),
        N.total("final_sale_price").alias("value_by_inquiry"))
    quotes = tables["fact_quote"].agg(
        N.rows().alias("quotes"), N.count_where(F.col("accepted_flag")).alias("accepted_quotes"),
        N.total("quote_amount", F.col("accepted_flag")).alias("value_by_quote"))
    both = inquiries.crossJoin(F.broadcast(quotes))
    return both.withColumn("reconciles", (F.col("quotes") == F.col("quotes_by_inquiry"))
                           & (F.col("conversions") == F.col("accepted_quotes"))
                           & (F.abs(F.col("value_by_inquiry") - F.col("value_by_quote")) <= 0.01))


