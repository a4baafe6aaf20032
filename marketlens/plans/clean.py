"""Clean, quarantine, reconcile and enrich the raw tables.

Each table becomes one tagged table: parsed columns, `_rule` with the first failed reject rule
and one boolean `_fix_<issue>` per correction. Curated rows, rejects and issue counts are then
plain filters and one aggregate over the stored tagged table, never a count per rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions import numbers as N
from marketlens.functions import text as T
from marketlens.functions.bands import band_below, band_upto
from marketlens.functions.calendar import calendar_columns
from marketlens.operators.dedupe import flag_later_copies, flag_stored_copies
from marketlens.operators.hot import HOT_ROWS, copies_stay_within, hot_buckets
from marketlens.operators.joins import join_null_safe, lookup, unknown_keys
from marketlens.operators.numbering import number_groups
from marketlens.operators.order_stats import cell_percentiles, value_cells
from marketlens.operators.rules import first_failure, passed, rejected
from marketlens.schema import (
    CORRECTIONS, FUEL_TYPES, KEYS, LEAD_SOURCES, MALFORMED_RULE, MILEAGE_BRACKETS, QUOTE_BUCKETS,
    RAW_COLUMNS, SOFT_FLAGS, STATUSES, VALUE_BANDS, VEHICLE_CONDITIONS, curated_schema,
)
from marketlens.session import Workspace, buckets_for

__all__ = ["Cleaned", "clean_tables"]


@dataclass
class Cleaned:
    """Curated tables, the tagged tables with the correction flags, and the rejected rows.

    `origins` holds the stored raw tables of rejects that do not carry their original row.
    """

    curated: dict[str, DataFrame]
    tagged: dict[str, list[DataFrame]] = field(default_factory=dict)
    rejects: dict[str, list[DataFrame]] = field(default_factory=dict)
    origins: dict[str, DataFrame] = field(default_factory=dict)


FACTS = ("fact_inquiry", "fact_quote")


def _prepare(raw: DataFrame, table: str, keys: list[str],
             cleaned: dict[str, str] | None = None) -> DataFrame:
    """Keep the raw columns for the quarantine payload and normalise the key columns.

    `cleaned` names the columns of the raw table that hold a key already normalised.
    """
    cleaned = cleaned or {}
    T.require_columns(raw, [*RAW_COLUMNS[table], "_ordinal"], table)
    return raw.select(
        *[F.col(name).alias(f"raw_{name}") for name in RAW_COLUMNS[table]],
        *[(F.col(cleaned[name]) if name in cleaned else T.business_key(name)).alias(name)
          for name in keys],
        "_ordinal")


def _tag(df: DataFrame, table: str, rules: list[tuple[str, Column]], columns: dict[str, Column],
         fixes: dict[str, Column], late: bool = False, kept: tuple[str, ...] = ()) -> DataFrame:
    """Final projection of a tagged table; only rejects carry the original row as JSON.

    Rejected facts keep only their key, rule, place and the `kept` columns. Where a shuffle would
    have to carry the original rows of a fact, it goes without (`late`) and `with_payload` looks
    them up for the rejects.
    """
    tagged = df.withColumn("_rule", first_failure(rules))
    payload = [] if late else [F.when(
        F.col("_rule").isNotNull(), T.record_json(RAW_COLUMNS[table], prefix="raw_"))
        .alias("_payload")]
    if table in FACTS:
        columns = {name: value if name in (KEYS[table], *kept) else F.when(F.col("_rule").isNull(), value)
                   for name, value in columns.items()}
    return tagged.select(
        *[expression.alias(name) for name, expression in columns.items()],
        *[flag.alias(f"_fix_{name}") for name, flag in fixes.items()],
        F.col("_rule"), F.col("_ordinal"), *payload)


def with_payload(rejects: DataFrame, raw: DataFrame, table: str) -> DataFrame:
    """Rejects with their original rows, found in the stored raw table by source order."""
    origin = raw.select(F.col("_ordinal").alias("_origin"),
                        T.record_json(RAW_COLUMNS[table]).alias("_payload"))
    return rejects.join(origin, F.col("_ordinal") == F.col("_origin")).drop("_origin")


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in curated_schema(table).fields])


def tag_customers(raw: DataFrame) -> DataFrame:
    df = flag_stored_copies(_prepare(raw, "dim_customer", ["customer_id"]), ["customer_id"])
    df = df.withColumns({
        "_created": N.to_day("raw_customer_created_date"),
        "_canton": T.business_key("raw_canton"),
        "_lead": T.canonical("raw_lead_source", LEAD_SOURCES)})
    created, canton, lead = F.col("_created"), F.col("_canton"), F.col("_lead")
    survives = ~F.col("_later_copy") & created.isNotNull()
    return _tag(
        df, "dim_customer",
        [("duplicate_primary_key", F.col("_later_copy")),
         ("malformed_customer_date", created.isNull())],
        {"customer_id": F.col("customer_id"), "customer_created_date": created,
         "age_group": T.title_case("raw_age_group"), "canton": T.or_unknown(canton),
         "customer_type": T.title_case("raw_customer_type"),
         "preferred_contact_method": T.title_case("raw_preferred_contact_method"),
         "lead_source": lead},
        {"missing_canton": survives & canton.isNull(),
         "inconsistent_lead_source_text":
             survives & F.coalesce(F.col("raw_lead_source") != lead, F.lit(False))})


def tag_vehicles(raw: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    df = flag_stored_copies(_prepare(raw, "dim_vehicle", ["vehicle_id"]), ["vehicle_id"])
    if catalog is None:
        brand = T.title_case("raw_brand")
    else:
        names = catalog.select(F.col("brand").alias("_brand")).distinct() \
            .groupBy(F.lower("_brand").alias("_spelling")).agg(F.min("_brand").alias("_brand"))
        df = lookup(df, names, F.lower(T.clean_text("raw_brand")), "_spelling",
                    {"_brand": "_brand"})
        brand = F.col("_brand")
    df = df.withColumns({
        "_fuel": T.canonical("raw_fuel_type", FUEL_TYPES),
        "_km": N.to_number("raw_mileage_km"),
        "_price": N.to_number("raw_estimated_market_value"),
        "_year": N.to_number("raw_manufacture_year")})
    fuel, value, year = F.col("_fuel"), F.col("_price"), F.col("_year")
    wrong_sign, mileage = N.fix_sign(F.col("_km"))
    kilometres = F.bround(mileage, 0)
    invalid = (~N.mileage_in_range(mileage) | ~F.coalesce(value > 0, F.lit(False))
               | ~N.year_in_range(year))
    money = F.bround(value, 2)
    first = ~F.col("_later_copy")
    return _tag(
        df, "dim_vehicle",
        [("duplicate_primary_key", F.col("_later_copy")), ("invalid_vehicle_domain", invalid)],
        {"vehicle_id": F.col("vehicle_id"), "brand": brand, "model": T.clean_text("raw_model"),
         "vehicle_type": T.title_case("raw_vehicle_type"), "fuel_type": T.or_unknown(fuel),
         "manufacture_year": year.try_cast("smallint"),
         "mileage_km": kilometres.try_cast("int"),
         "estimated_market_value": money.try_cast("decimal(12,2)"),
         "vehicle_condition": T.canonical("raw_vehicle_condition", VEHICLE_CONDITIONS),
         "mileage_bracket": band_upto(kilometres, MILEAGE_BRACKETS, above=-1),
         "market_value_band": band_below(money, VALUE_BANDS, floor=0)},
        {"missing_fuel_type": first & fuel.isNull(),
         "negative_mileage_sign_error": first & wrong_sign})


def tag_dealers(raw: DataFrame) -> DataFrame:
    df = flag_later_copies(_prepare(raw, "dim_dealer", ["dealer_id"]), ["dealer_id"])
    return _tag(
        df, "dim_dealer",
        [("duplicate_primary_key", F.col("_later_copy")),
         ("invalid_dealer_rating", ~N.valid_rating("raw_dealer_rating"))],
        {"dealer_id": F.col("dealer_id"), "dealer_name": T.clean_text("raw_dealer_name"),
         "dealer_region": T.clean_text("raw_dealer_region"),
         "dealer_type": T.clean_text("raw_dealer_type"),
         "dealer_rating": F.bround(N.to_number("raw_dealer_rating"), 2)
             .try_cast("decimal(3,2)"),
         "active_flag": T.to_flag("raw_active_flag")},
        {"dealer_name_whitespace": T.has_outer_blanks("raw_dealer_name")})


def tag_dates(raw: DataFrame) -> DataFrame:
    df = _prepare(raw, "dim_date", []).withColumn("_day", N.to_day("raw_date"))
    df = flag_later_copies(df, ["_day"])
    columns = dict(zip([f.name for f in curated_schema("dim_date").fields],
                       calendar_columns("_day")))
    return _tag(df, "dim_date",
                [("invalid_date_dimension_key",
                  F.col("_day").isNull() | F.col("_later_copy"))],
                columns, {})


def tag_inquiries(raw: DataFrame, customers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Dedupe and check inquiries; market value and build year come along for enrichment."""
    df = _prepare(raw, "fact_inquiry",
                  ["inquiry_id", "customer_id", "vehicle_id", "winning_dealer_id"],
                  {"inquiry_id": QUOTE_BUCKETS} if QUOTE_BUCKETS in raw.columns else {})
    df = df.select(
        "inquiry_id", "customer_id", "vehicle_id", "winning_dealer_id", "_ordinal",
        N.to_day("raw_inquiry_date").alias("_day"),
        T.canonical("raw_lead_source", LEAD_SOURCES).alias("lead_source"),
        T.canonical("raw_status", STATUSES).alias("status"),
        N.to_number("raw_final_sale_price").alias("final_sale_price"),
        T.to_flag("raw_conversion_flag").alias("conversion_flag"),
        N.to_number("raw_days_to_conversion").try_cast("smallint").alias("days_to_conversion"))
    df = flag_stored_copies(df, ["inquiry_id"])
    df = lookup(df, customers.withColumn("_known", F.lit(True)), "customer_id", "customer_id",
                {"customer_created_date": "_created", "_known": "_customer"})
    df = lookup(df, vehicles.withColumn("_known", F.lit(True)), "vehicle_id", "vehicle_id",
                {"manufacture_year": "_year", "estimated_market_value": "_value",
                 "_known": "_vehicle"})
    day = F.col("_day")
    orphan = ((F.col("customer_id").isNotNull() & F.col("_customer").isNull())
              | (F.col("vehicle_id").isNotNull() & F.col("_vehicle").isNull()))
    return _tag(
        df, "fact_inquiry",
        [("duplicate_primary_key", F.col("_later_copy")),
         ("malformed_inquiry_date", day.isNull()),
         ("invalid_inquiry_foreign_key", orphan),
         ("customer_date_sequence", F.coalesce(day < F.col("_created"), F.lit(False)))],
        {"inquiry_id": F.col("inquiry_id"), "customer_id": F.col("customer_id"),
         "vehicle_id": F.col("vehicle_id"), "inquiry_date": day,
         **{name: F.col(name) for name in (
             "lead_source", "status", "final_sale_price", "winning_dealer_id", "conversion_flag",
             "days_to_conversion")},
         "estimated_market_value": F.col("_value"),
         "vehicle_age_at_inquiry": (F.year(day) - F.col("_year")).cast("smallint")},
        {}, late=True)


def tag_quotes(raw: DataFrame, inquiries: DataFrame, dealers: DataFrame,
               limit: int = HOT_ROWS) -> DataFrame:
    # Rows stored by the cleaned key of their inquiry are joined and ranked where they lie.
    keyed = QUOTE_BUCKETS in raw.columns
    df = _prepare(raw, "fact_quote", ["quote_id", "inquiry_id", "dealer_id"],
                  {"inquiry_id": QUOTE_BUCKETS} if keyed else {})
    df = df.select(
        "quote_id", "inquiry_id", "dealer_id", "_ordinal",
        *([c for c in df.columns if c.startswith("raw_")] if keyed else []),
        N.to_day("raw_quote_date").alias("_day"), N.to_number("raw_quote_amount").alias("_amount"),
        N.to_number("raw_response_time_hours").alias("response_time_hours"),
        T.to_flag("raw_accepted_flag").alias("accepted_flag"))
    # Copies that share an inquiry are told apart in the shuffle of the inquiry lookup.
    within = copies_stay_within(df, "quote_id", "inquiry_id", limit)
    if not within:
        df = flag_stored_copies(df, ["quote_id"], limit=limit)
    df = lookup(df, unknown_keys(df, "dealer_id", dealers, "dealer_id"), "dealer_id", "_unknown",
                {"_unknown": "_unknown_dealer"})
    df = lookup(df, inquiries, "inquiry_id", "inquiry_id",
                {"inquiry_date": "_inquired", "inquiry_id": "_inquiry"})
    if within:
        copies = Window.partitionBy("inquiry_id", "quote_id").orderBy("_ordinal")
        df = df.withColumn("_later_copy", F.rank().over(copies) > 1)
    day, amount = F.col("_day"), F.col("_amount")
    orphan = ((F.col("inquiry_id").isNotNull() & F.col("_inquiry").isNull())
              | F.col("_unknown_dealer").isNotNull())
    return _tag(
        df, "fact_quote",
        [("duplicate_primary_key", F.col("_later_copy")),
         ("invalid_quote_domain", day.isNull() | ~N.amount_in_range(amount)),
         ("invalid_quote_foreign_key", orphan),
         ("quote_date_sequence", ~N.date_sequence(day, F.col("_inquired")))],
        {"quote_id": F.col("quote_id"), "inquiry_id": F.col("inquiry_id"),
         "dealer_id": F.col("dealer_id"), "quote_date": day, "quote_amount": amount,
         "response_time_hours": F.col("response_time_hours"),
         "accepted_flag": F.col("accepted_flag")},
        {}, late=not keyed, kept=("inquiry_id",) if keyed else ())


def impute_response(quotes: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fill a missing response time with the dealer median, else the median of all quotes.

    Only the rows with a gap are joined to the medians, so known rows are never shuffled. Of quotes
    bucketed by inquiry the filled ones are dealt back to their buckets.
    """
    hours = F.col("response_time_hours")
    known = quotes.filter(hours.isNotNull()).withColumn("_fix_missing_response_time", F.lit(False))
    cells = value_cells(quotes, ["dealer_id"], "response_time_hours", 6)
    by_dealer = cell_percentiles(cells, ["dealer_id"], 6, {"_dealer_median": (1, 2)})
    overall = cell_percentiles(cells, [], 6, {"_median": (1, 2)})
    gaps = lookup(quotes.filter(hours.isNull()), by_dealer, "dealer_id", "dealer_id",
                  {"_dealer_median": "_dealer_median"})
    filled = (gaps.crossJoin(F.broadcast(overall)).withColumn(
        "response_time_hours", F.coalesce("_dealer_median", "_median").cast(N.PARSED))
        .drop("_dealer_median", "_median")
        .withColumn("_fix_missing_response_time", F.lit(True)))
    if buckets:
        filled = filled.repartition(buckets, "inquiry_id")
    return known.unionByName(filled)


def reconcile_inquiries(inquiries: DataFrame, quotes: DataFrame) -> DataFrame:
    """Make outcomes agree with the surviving accepted quotes and add the quote summary."""
    amount, hours = F.col("quote_amount"), F.col("response_time_hours")
    # A converted inquiry keeps its outcome only with exactly one accepted quote, so which
    # of several is read here never matters.
    summary = quotes.groupBy("inquiry_id").agg(
        F.count("quote_id").alias("quote_count"), F.max(amount).alias("highest"),
        F.min(amount).alias("lowest"), F.sum(amount).alias("_amounts"),
        F.min(hours).alias("fastest"),
        N.count_where(F.col("accepted_flag")).alias("_accepted"),
        F.min(F.when(F.col("accepted_flag"), F.struct("dealer_id", "quote_amount")))
        .alias("_won"))
    df = inquiries.join(summary.withColumnRenamed("inquiry_id", "_s"),
                        F.col("inquiry_id") == F.col("_s"), "left").drop("_s")
    lost = F.col("conversion_flag") & (F.coalesce("_accepted", F.lit(0)) != 1)
    converted = F.col("conversion_flag") & ~lost
    spread = F.col("highest") - F.col("lowest")
    no_quote = F.col("quote_count").isNull()
    return df.select(
        "inquiry_id", "customer_id", "vehicle_id", "inquiry_date", "lead_source",
        F.when(lost, "Lost").otherwise(F.col("status")).alias("status"),
        F.when(converted, F.bround("_won.quote_amount", 2)).cast("decimal(12,2)")
        .alias("final_sale_price"),
        F.when(converted, F.col("_won.dealer_id")).alias("winning_dealer_id"),
        converted.alias("conversion_flag"),
        F.when(converted, F.col("days_to_conversion")).alias("days_to_conversion"),
        F.col("quote_count"),
        F.bround("highest", 2).cast("decimal(12,2)").alias("highest_quote"),
        F.bround("lowest", 2).cast("decimal(12,2)").alias("lowest_quote"),
        F.bround(N.ratio(F.col("_amounts"), F.col("quote_count")), 2).cast("decimal(12,2)")
        .alias("average_quote"),
        F.bround("fastest", 2).cast("decimal(8,2)").alias("fastest_response_hours"),
        F.bround(spread, 2).cast("decimal(12,2)").alias("quote_spread"),
        F.bround(F.try_divide(spread, F.col("lowest")), 4).cast("decimal(10,4)")
        .alias("quote_spread_pct"),
        "vehicle_age_at_inquiry", "estimated_market_value",
        lost.alias("_fix_accepted_quote_removed_by_quality_rule"),
        (converted & F.coalesce(F.col("winning_dealer_id") != F.col("_won.dealer_id"),
                                F.lit(False))).alias("_fix_winning_dealer_mismatch"),
        F.when(no_quote, F.lit("inquiry_without_quote")).alias("_rule"))


def unquoted_inquiries(inquiries: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Rejects of the reconciliation with the source order of their rows."""
    left_out = rejected(reconciled).select("inquiry_id", F.col("_rule").alias("_late_rule"))
    return join_null_safe(inquiries, left_out, ["inquiry_id"]).select(
        "inquiry_id", F.col("_late_rule").alias("_rule"), "_ordinal")


def enrich_quotes(quotes: DataFrame, inquiries: DataFrame, workspace: Workspace) -> DataFrame:
    """Outcome, market value, ratio, soft anomaly flag and rank inside the inquiry."""
    known = inquiries.select(
        F.col("inquiry_id").alias("_i"), "estimated_market_value",
        F.col("conversion_flag").alias("_converted"))
    df = quotes.join(known, F.col("inquiry_id") == F.col("_i"), "left").drop("_i")
    df = number_groups(workspace, df, "quote_slices", "inquiry_id",
                       [F.col("quote_amount").desc(), F.col("_ordinal")], "quote_rank",
                       hot_buckets(quotes, ["inquiry_id"]))
    ratio = F.bround(F.try_divide(F.col("quote_amount"), F.col("estimated_market_value")), 4)
    still = F.col("accepted_flag") & F.coalesce("_converted", F.lit(False))
    return df.select(
        "quote_id", "inquiry_id", "dealer_id", "quote_date",
        F.bround("quote_amount", 2).cast("decimal(12,2)").alias("quote_amount"),
        F.bround("response_time_hours", 2).cast("decimal(8,2)").alias("response_time_hours"),
        F.col("quote_rank").cast("bigint").alias("quote_rank"),
        still.alias("accepted_flag"), "estimated_market_value",
        ratio.cast("decimal(12,4)").alias("quote_to_market_ratio"),
        N.outside_market(ratio).alias("_fix_quote_to_market_anomaly"),
        "_fix_missing_response_time",
        (F.col("accepted_flag") & ~still).alias("_fix_accepted_quote_without_conversion"))


def split_malformed(raw: dict[str, DataFrame]) -> tuple[dict, dict]:
    """Raw tables without the records their reader could not cut into fields, and those as rejects."""
    marked = [table for table in raw if "_malformed" in raw[table].columns]
    rejects = {table: raw[table].filter("_malformed is not null").select(
        F.lit(None).cast("string").alias(KEYS[table]), F.lit(MALFORMED_RULE).alias("_rule"),
        "_ordinal", F.to_json(F.struct(F.col("_malformed").alias("record"))).alias("_payload"))
        for table in marked}
    return {**raw, **{table: raw[table].filter("_malformed is null").drop("_malformed")
                      for table in marked}}, rejects


def clean_tables(raw: dict[str, DataFrame], workspace: Workspace,
                 catalog: DataFrame | None = None) -> Cleaned:
    """Run the whole waterfall; every stage is written once and read by all later ones.

    The raw tables should be stored: rejected facts are looked up in them again by `_ordinal`.
    """
    stage = workspace.stage
    raw, malformed = split_malformed(raw)
    customers, vehicles, dealers, dates = workspace.stage_all({
        "tagged_customer": tag_customers(raw["dim_customer"]),
        "tagged_vehicle": tag_vehicles(raw["dim_vehicle"], catalog),
        "tagged_dealer": tag_dealers(raw["dim_dealer"]),
        "tagged_date": tag_dates(raw["dim_date"]),
    }).values()
    # What is bucketed by inquiry stays so, and is joined, reconciled and ranked without a shuffle.
    keyed = QUOTE_BUCKETS in raw["fact_quote"].columns
    buckets = buckets_for(raw["fact_quote"]) if keyed else None
    by_inquiry = ("inquiry_id", buckets) if keyed else ()
    tagged_inquiries = stage(
        tag_inquiries(raw["fact_inquiry"], passed(customers), passed(vehicles)),
        "tagged_inquiry", *by_inquiry)
    open_inquiries = passed(tagged_inquiries)
    tagged = tag_quotes(raw["fact_quote"], open_inquiries, passed(dealers))
    tagged_quotes = stage(tagged, "tagged_quote", *by_inquiry)
    filled = stage(impute_response(passed(tagged_quotes).drop("_payload"), buckets),
                   "filled_quote", *by_inquiry, placed=True)
    inquiries = stage(reconcile_inquiries(open_inquiries, filled), "reconciled_inquiry",
                      *by_inquiry)
    quotes = stage(
        enrich_quotes(filled, passed(inquiries), workspace)
        .withColumn("anomaly_flag", F.col("_fix_quote_to_market_anomaly")), "enriched_quote")
    curated = {
        "dim_customer": passed(customers), "dim_vehicle": passed(vehicles),
        "dim_dealer": passed(dealers), "dim_date": passed(dates),
        "fact_inquiry": passed(inquiries), "fact_quote": quotes,
    }
    charged = {
        "dim_customer": [rejected(customers)], "dim_vehicle": [rejected(vehicles)],
        "dim_dealer": [rejected(dealers)], "dim_date": [rejected(dates)],
        "fact_inquiry": [rejected(tagged_inquiries),
                         unquoted_inquiries(open_inquiries, inquiries)],
        "fact_quote": [rejected(tagged_quotes)],
    }
    return Cleaned(
        curated={name: _typed(df, name) for name, df in curated.items()},
        tagged={
            "dim_customer": [customers], "dim_vehicle": [vehicles], "dim_dealer": [dealers],
            "dim_date": [dates], "fact_inquiry": [tagged_inquiries, inquiries],
            "fact_quote": [tagged_quotes.drop("_payload"), quotes],
        },
        rejects={table: [*([malformed[table]] if table in malformed else []), *found]
                 for table, found in charged.items()},
        origins={name: raw[name] for name in FACTS})


def known_issues(table: str) -> dict[str, tuple[str, str]]:
    """Corrections and soft flags of a table as issue -> (action, result)."""
    return {**CORRECTIONS[table], **SOFT_FLAGS.get(table, {})}


