"""Present order, line-item and party tables as raw marketplace tables.

Orders become inquiries and line items their competing quotes; customers, parts and suppliers
become the dimensions. Values keep the defects the source has (repeated line numbers, ship
dates before order dates, orders without lines) and attributes the source lacks are derived
from its columns, partly in untidy spellings, so that every cleaning rule has work to do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions import text as T
from marketlens.functions.calendar import date_spine
from marketlens.operators.hot import HOT_ROWS, hot_buckets, split_hot
from marketlens.operators.joins import join_null_safe
from marketlens.schema import QUOTE_BUCKETS
from marketlens.session import Workspace, buckets_for

# Source words as the raw layer spells them.
LEAD_TEXT = {
    "1-URGENT": "  dealer referral ", "2-HIGH": "Social Media", "3-MEDIUM": "ORGANIC SEARCH",
    "4-NOT SPECIFIED": "paid search ", "5-LOW": "Direct",
}
CUSTOMER_LEADS = [
    "Organic Search", " paid search", "Dealer Referral", "SOCIAL MEDIA", "Direct", "partner ",
    "billboard",
]
STATUS_TEXT = {"F": " converted ", "O": "OPEN", "P": "lost"}
FUEL_TEXT = ["petrol ", "DIESEL", "Hybrid", "electric", "Petrol"]
CONTACT_TEXT = ["email", "PHONE", "text message", "in-person", "Email"]
DEALER_TYPES = ["Franchise", " Independent", "Broker "]


def _word(position: Column, words: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), position.cast("int") + 1)


def _translate(value: str, words: dict[str, str]) -> Column:
    pairs = [F.lit(item) for pair in words.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(value))


def _id(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _money(value: str) -> Column:
    return F.col(value).cast("decimal(12,2)")


def _ordinal(*columns: str) -> Column:
    """Source order: the named columns, then the physical row so that no two rows tie."""
    return F.struct(*columns, F.col("_file"), F.col("_row")).alias("_ordinal")


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return (spark.read.parquet(f"{folder}/{table}.parquet")
            .select("*", F.xxhash64("_metadata.file_name").alias("_file"),
                    F.col("_metadata.row_index").alias("_row")))


def _with_copies(df: DataFrame, repeated: Column, **changed: Column) -> DataFrame:
    """Append a changed later copy of some rows, as a re-sent extract would."""
    first = df.withColumn("_copy", F.lit(0))
    again = df.filter(repeated).withColumns({**changed, "_copy": F.lit(1)})
    return first.unionByName(again)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    balance = _money("c_acctbal")
    created = F.date_add(F.to_date(F.lit("1994-06-01")), F.floor(balance / 20).cast("int"))
    rows = _read(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        _id("C", "c_custkey").alias("customer_id"),
        F.when(balance < -950, "2025-99-41").otherwise(created.cast("string"))
        .alias("customer_created_date"),
        F.when(balance < 1500, "18-24").when(balance < 4000, "25-34")
        .when(balance < 6500, "35-44").when(balance < 9000, "45-64").otherwise("65+ years")
        .alias("age_group"),
        F.when(balance.between(0, 150), "  ").otherwise(F.lower("n_name")).alias("canton"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_type"),
        _word(F.col("n_regionkey"), CONTACT_TEXT).alias("preferred_contact_method"),
        _word(F.col("c_nationkey") % 7, CUSTOMER_LEADS).alias("lead_source"),
        balance.alias("_balance"), F.col("_file"), F.col("_row"))
    rows = _with_copies(rows, F.col("_balance") > 9800, canton=F.lit("ZZ"))
    return rows.withColumn("_ordinal", _ordinal("_copy")).drop("_balance", "_copy", "_file", "_row")


def vehicles(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return _read(spark, folder, "part").select(
        _id("V", "p_partkey").alias("vehicle_id"),
        F.concat(F.lit("  "), F.upper("p_brand")).alias("brand"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("model"),
        F.col("p_type").alias("vehicle_type"),
        F.when(size == 25, "steam").when((F.col("p_type") != "PROMO") | (size >= 10),
                                         _word(size % 5, FUEL_TEXT)).alias("fuel_type"),
        F.when(size == 49, 1989).otherwise(1990 + F.col("p_partkey") % 6).cast("string")
        .alias("manufacture_year"),
        (size * 10_600 - 20_000).cast("string").alias("mileage_km"),
        (_money("p_retailprice") * (size * 2 + 6)).cast("string").alias("estimated_market_value"),
        F.when(size < 13, "excellent").when(size < 26, "Good").when(size < 38, "FAIR ")
        .otherwise("poor").alias("vehicle_condition"),
        _ordinal())


def dealers(spark: SparkSession, folder: str) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    balance = _money("s_acctbal")
    rows = _read(spark, folder, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        _id("D", "s_suppkey").alias("dealer_id"),
        F.when(balance < 0, F.concat(F.lit("  "), F.col("s_name"))).otherwise(F.col("s_name"))
        .alias("dealer_name"),
        F.col("r_name").alias("dealer_region"),
        _word(F.col("s_nationkey") % 3, DEALER_TYPES).alias("dealer_type"),
        F.round((balance + 900) / 2100, 2).cast("string").alias("dealer_rating"),
        F.when(balance >= 500, "Yes").otherwise("no").alias("active_flag"),
        balance.alias("_balance"), F.col("_file"), F.col("_row"))
    rows = _with_copies(rows, F.col("_balance").between(4000, 4200), dealer_type=F.lit("Broker"))
    return rows.withColumn("_ordinal", _ordinal("_copy")).drop("_balance", "_copy", "_file", "_row")


# Source order of a line within its order and over all orders.
LINE_ORDER = ["ship_day", "l_partkey", "l_suppkey", "price", "_file", "_row"]


def _inquiry_key(order: str) -> Column:
    """The inquiry of an order as cleaning spells it; lines are stored by it."""
    return T.business_key(_id("I", order))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "lineitem").select(
        _inquiry_key("l_orderkey").alias(QUOTE_BUCKETS), "l_orderkey", "l_linenumber",
        "l_partkey", "l_suppkey",
        _money("l_extendedprice").alias("price"), _money("l_quantity").alias("hours"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"), "l_returnflag",
        F.to_date("l_shipdate").alias("ship_day"), "_file", "_row")


def _marked(lines: DataFrame) -> DataFrame:
    """`_best`, the best bid of its order, and `_first_part`, the part of the first line."""
    inside = Window.partitionBy(QUOTE_BUCKETS)
    bids = inside.orderBy(*[F.col(c).desc() for c in ("price", "l_linenumber", *LINE_ORDER)])
    return lines.withColumn("_best", F.row_number().over(bids) == 1).withColumn(
        "_first_part",
        F.min(F.struct("l_linenumber", "ship_day", "l_partkey")).over(inside)["l_partkey"])


def _marked_hot(lines: DataFrame) -> DataFrame:
    """As `_marked` for orders of any size; both aggregates combine map-side."""
    per_order = lines.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "ship_day", "l_partkey")).alias("_start"),
        F.max(F.struct("price", "l_linenumber", F.struct(*LINE_ORDER).alias("place")))
        .alias("_top"))
    joined = join_null_safe(lines, per_order.hint("merge"), ["l_orderkey"], "left")
    own = F.struct("price", "l_linenumber", F.struct(*LINE_ORDER).alias("place"))
    return joined.withColumns({
        "_best": own.eqNullSafe(F.col("_top")), "_first_part": F.col("_start.l_partkey")}).drop(
        "_start", "_top")


def order_lines(spark: SparkSession, folder: str, limit: int = HOT_ROWS,
                workspace: Workspace | None = None) -> DataFrame:
    """The lines with their marks and `_won`, whether their order is won; one shuffle by order.

    With a workspace they are stored, in buckets by `_inquiry_key`, which then stands for the order
    key, unless an order is hot: the join that splits a hot order has to shuffle.
    """
    lines = _lines(spark, folder)
    won = spark.read.parquet(f"{folder}/orders.parquet").filter("o_orderstatus = 'F'").select(
        _inquiry_key("o_orderkey").alias("order_key"))
    usual, hot = split_hot(lines, ["l_orderkey"], hot_buckets(lines, ["l_orderkey"], limit))
    bucketed = workspace is not None and hot is None
    if bucketed:
        buckets = buckets_for(spark.read.parquet(f"{folder}/lineitem.parquet"))
        usual = usual.drop("l_orderkey").repartition(buckets, QUOTE_BUCKETS)
    parts = [_marked(usual)] + ([] if hot is None else [_marked_hot(hot)])
    marked = reduce(lambda a, b: a.unionByName(b), [
        part.join(won, F.col(QUOTE_BUCKETS) == F.col("order_key"), "left")
        .withColumn("_won", F.col("order_key").isNotNull()).drop("order_key") for part in parts])
    if workspace is None:
        return marked
    if bucketed:
        return workspace.stage(marked, "order_lines", QUOTE_BUCKETS, buckets)
    return workspace.stage(marked.drop(QUOTE_BUCKETS), "order_lines")


def _per_order(lines: DataFrame) -> DataFrame:
    """First part and best bid of each order."""
    key = F.col(QUOTE_BUCKETS) if QUOTE_BUCKETS in lines.columns else _inquiry_key("l_orderkey")
    return lines.filter("_best").groupBy(key.alias("order_key")).agg(
        F.first("_first_part").alias("part_key"), F.first("price").alias("best_price"),
        F.first("l_suppkey").alias("best_dealer"), F.first("ship_day").alias("best_day"))


def inquiries(spark: SparkSession, folder: str, per_order: DataFrame) -> DataFrame:
    amount = _money("o_totalprice")
    day = F.to_date("o_orderdate")
    won = F.col("o_orderstatus") == "F"
    orders = _read(spark, folder, "orders")
    rows = orders.join(per_order, _inquiry_key("o_orderkey") == F.col("order_key"), "left").select(
        _id("I", "o_orderkey").alias("inquiry_id"),
        _id("C", "o_custkey").alias("customer_id"),
        _id("V", "part_key").alias("vehicle_id"),
        F.when(amount < 6000, "2025-99-41").otherwise(day.cast("string")).alias("inquiry_date"),
        _translate("o_orderpriority", LEAD_TEXT).alias("lead_source"),
        F.when((F.col("o_orderstatus") == "P") & (amount > 400_000), "Expired")
        .otherwise(_translate("o_orderstatus", STATUS_TEXT)).alias("status"),
        F.when(won, F.col("best_price")).cast("string").alias("final_sale_price"),
        F.when(won & (amount > 450_000), "D-9999")
        .when(won, _id("D", "best_dealer")).alias("winning_dealer_id"),
        F.when(won, "Yes").otherwise("no").alias("conversion_flag"),
        F.when(won, F.abs(F.date_diff(F.col("best_day"), day))).cast("string")
        .alias("days_to_conversion"),
        _inquiry_key("o_orderkey").alias(QUOTE_BUCKETS),
        amount.alias("_amount"), F.col("_file"), F.col("_row"))
    rows = _with_copies(rows, F.col("_amount") > 495_000, status=F.lit("Open"))
    return rows.withColumn("_ordinal", _ordinal("_copy")).drop("_amount", "_copy", "_file", "_row")


def quotes(lines: DataFrame) -> DataFrame:
    accepted = F.col("_best") & F.col("_won") & F.col("l_linenumber").isNotNull()
    dealer = _id("D", "l_suppkey")
    keyed = QUOTE_BUCKETS in lines.columns
    order = F.substr(QUOTE_BUCKETS, F.lit(2)) if keyed else F.col("l_orderkey").cast("string")
    return lines.select(
        F.concat(F.lit("Q"), order, F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("quote_id"),
        F.concat(F.lit("I"), order).alias("inquiry_id"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), F.lower(dealer)))
        .otherwise(dealer).alias("dealer_id"),
        F.when((F.col("hours") == 50) & (F.col("tax") == 0), "not-a-date")
        .otherwise(F.col("ship_day").cast("string")).alias("quote_date"),
        F.when((F.col("discount") == F.lit(0.10).cast("decimal(4,2)"))
               & (F.col("tax") == F.lit(0.08).cast("decimal(4,2)")), "-1")
        .when((F.col("discount") == 0) & (F.col("tax") == 0), "9999999")
        .otherwise(F.col("price").cast("string")).alias("quote_amount"),
        F.when(F.col("discount") != 0, F.col("hours").cast("string"))
        .alias("response_time_hours"),
        F.col("l_linenumber").cast("string").alias("quote_rank"),
        F.when(accepted, "true").otherwise("false").alias("accepted_flag"),
        F.struct(*LINE_ORDER).alias("_ordinal"),
        *([QUOTE_BUCKETS] if keyed else []))


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar covering every order and ship date; attributes are rebuilt by cleaning."""
    ordered = spark.read.parquet(f"{folder}/orders.parquet").agg(
        F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high"))
    shipped = spark.read.parquet(f"{folder}/lineitem.parquet").agg(
        F.to_date(F.min("l_shipdate")).alias("low"), F.to_date(F.max("l_shipdate")).alias("high"))
    bounds = ordered.union(shipped).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    day = F.col("date")
    return date_spine(bounds, "low", "high").select(
        day.cast("string").alias("date"), F.year(day).cast("string").alias("year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.month(day).cast("string").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("string").alias("week"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).cast("string").alias("is_weekend"),
        F.struct("date").alias("_ordinal"))


def raw_tables(spark: SparkSession, folder: str,
               workspace: Workspace | None = None) -> dict[str, DataFrame]:
    """The six raw tables; with a workspace they are landed once and read back from there."""
    lines = order_lines(spark, folder, workspace=workspace)
    tables = {
        "dim_customer": customers(spark, folder), "dim_vehicle": vehicles(spark, folder),
        "dim_dealer": dealers(spark, folder),
        "fact_inquiry": inquiries(spark, folder, _per_order(lines)),
        "dim_date": dates(spark, folder),
    }
    if QUOTE_BUCKETS not in lines.columns or workspace is None:
        tables["fact_inquiry"] = tables["fact_inquiry"].drop(QUOTE_BUCKETS)
    if workspace is not None:
        # Inquiries come from a join with the lines, so they lie as these do.
        by_inquiry = {"raw_fact_inquiry": (QUOTE_BUCKETS, buckets_for(lines), True)} \
            if QUOTE_BUCKETS in tables["fact_inquiry"].columns else {}
        landed = workspace.stage_all({f"raw_{name}": df for name, df in tables.items()}, by_inquiry)
        tables = {name: landed[f"raw_{name}"] for name in tables}
    # Quotes are the stored lines in other words, so they are not written again.
    return {**tables, "fact_quote": quotes(lines)}


def brand_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Brands in another spelling, as a catalogue of vehicles."""
    return spark.read.parquet(f"{folder}/part.parquet").select(
        F.lower("p_brand").alias("brand"), F.col("p_name").alias("model"),
        F.col("p_type").alias("vehicle_type"))


def canton_regions(spark: SparkSession, folder: str) -> DataFrame:
    """The region of every canton."""
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper("n_name").alias("canton"), F.col("r_name").alias("dealer_region"))
