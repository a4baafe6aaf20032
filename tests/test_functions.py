"""Boundaries and missing values of the column builders."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketlens.functions import bands, calendar, numbers, text
from marketlens.operators.dedupe import flag_all_copies
from marketlens.operators.joins import (
    CardinalityError, checked_join, compare_by_key, orphan_counts, spine_join,
)
from marketlens.plans.quality import accepted_quote_violations
from marketlens.schema import (
    AGE_BANDS, ISSUE_CATEGORIES, LEAD_SOURCES, METRIC_LABELS, MILEAGE_BRACKETS, RESPONSE_BANDS,
    VALUE_BANDS,
)

from tests.conftest import column, rows


def values(spark, data, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")


def result(spark, data, expression, kind="string"):
    return column(values(spark, data, kind).orderBy("i").select(expression.alias("r")), "r")


def test_mileage_domain(spark):
    assert result(spark, ["-1", "0", "500000", "500001", None], numbers.valid_mileage("v")) == [
        False, True, True, False, False]


def test_amount_domain(spark):
    assert result(spark, ["-1", "0", "1", "500000", "500001", None, "x"],
                  numbers.valid_quote_amount("v")) == [
        False, False, True, True, False, False, False]


def test_date_sequence(spark):
    df = spark.createDataFrame(
        [("2022-01-02", "2022-01-01"), ("2022-01-01", "2022-01-02"), ("bad", "2022-01-01")],
        "q string, i string")
    assert column(df.select(numbers.date_sequence(
        numbers.to_day("q"), numbers.to_day("i")).alias("r")), "r") == [True, False, False]


def test_all_copies_are_marked(spark):
    df = flag_all_copies(values(spark, ["A", "B", "B", "C", None, None]), ["v"]).orderBy("i")
    assert column(df, "_copied") == [False, True, True, False, True, True]


def test_foreign_key_allows_null(spark):
    child, parent = values(spark, ["D1", "D9", None]), values(spark, ["D1", "D2", "D2", None])
    assert rows(orphan_counts(child, "v", parent, "v")) == [(3, 2, 1)]


def test_names():
    assert text.snake_case(" Customer ID ") == "customer_id"
    assert text.snake_case("Quote-Amount (CHF)") == "quote_amount_chf"


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"t is missing required columns: \['a', 'b'\]"):
        text.require_columns(values(spark, ["x"]), ["b", "a", "v"], "t")


def test_text(spark):
    assert result(spark, [" a\t", "", "  ", None], text.clean_text("v")) == [
        "a", None, None, None]
    assert result(spark, ["SUV", "65+ x-y", "o'neil", "  in-person "], text.title_case("v")) == [
        "Suv", "65+ X-Y", "O'Neil", "In-Person"]
    assert result(spark, [" dealer REFERRAL", "billboard", None],
                  text.canonical("v", LEAD_SOURCES)) == ["Dealer Referral", None, None]
    assert result(spark, ["Yes", "1", " T ", "no", "maybe", None], text.to_flag("v")) == [
        True, True, True, False, False, False]
    assert result(spark, ["N/A", "nan", "NULL", "x", ""], text.null_tokens("v")) == [
        None, None, None, "x", None]
    assert result(spark, ["duplicate_primary_key", "quote_date_sequence", "odd",
                          "Missing_Canton"],
                  text.category_of("v", ISSUE_CATEGORIES)) == [
        "Duplicate keys", "Invalid dates", "Other", "Missing values"]
    assert result(spark, ["validity_rate", "x"], text.label_of("v", METRIC_LABELS)) == [
        "Validity", "Other"]
    assert result(spark, ["a_b"], text.prettify("v")) == ["A B"]


def test_record_json_sorts_keys_and_spells_null(spark):
    df = spark.createDataFrame([("1", None)], "b string, a string")
    assert json.loads(df.select(text.record_json(["b", "a"])).first()[0]) == {
        "a": "<NULL>", "b": "1"}


def test_bands(spark):
    assert result(spark, [0, 25000, 25001, 200001, 500000],
                  bands.band_upto(F.col("v"), MILEAGE_BRACKETS, above=-1), "int") == [
        "0-25k", "0-25k", "25k-75k", "200k+", "200k+"]
    assert result(spark, [9999, 10000, 80000], bands.band_below(F.col("v"), VALUE_BANDS), "int"
                  ) == ["<10k", "10k-25k", "80k+"]
    assert result(spark, [-1, 0, 2, 3, 9, 10],
                  bands.band_upto(F.col("v"), AGE_BANDS, above=-1), "int") == [
        None, "0-2 years", "0-2 years", "3-5 years", "6-9 years", "10+ years"]
    assert result(spark, [3, 4, 24], bands.band_below(F.col("v"), RESPONSE_BANDS), "int") == [
        "<4 hours", "4-8 hours", "24+ hours"]


def test_rounding(spark):
    halves = spark.createDataFrame([(25,), (0,)], "v int").select(
        F.sum("v").cast("decimal(10,0)").alias("s"))
    assert float(halves.select(numbers.ratio_up(F.col("s"), F.lit(200), 2)).first()[0]) == 0.13
    assert float(halves.select(
        F.bround(numbers.ratio(F.col("s"), F.lit(200)), 2)).first()[0]) == 0.12
    assert halves.select(numbers.ratio_up(F.col("s"), F.lit(0), 2)).first()[0] is None


def test_bounded_rate(spark):
    df = spark.createDataFrame([(0, 0), (3, 4), (5, 4)], "p int, n int")
    assert column(df.select(numbers.bounded_rate(F.col("p"), F.col("n")).alias("r")), "r") == [
        1.0, 0.75, 1.0]


def test_wilson(spark):
    low, high = numbers.wilson_interval(F.lit(50), F.lit(100))
    a, b = spark.range(1).select(low, high).first()
    assert (round(a, 4), round(b, 4)) == (0.4038, 0.5962)


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),)], "date date").select(
        *calendar.calendar_columns())
    assert rows(df) == [(dt.date(2022, 1, 1), 2022, "Q1", 1, "January", 52, "Saturday", True)]
    assert spark.range(1).select(
        calendar.month_start(F.lit(2022), F.lit(3))).first()[0] == dt.date(2022, 3, 1)


def test_checked_join(spark):
    left = values(spark, ["a", "a"]).select("v")
    right = values(spark, ["a", "b"]).select("v")
    assert checked_join(left, right, ["v"], validate="m:1").count() == 2
    with pytest.raises(CardinalityError, match="left side"):
        checked_join(left, right, ["v"], validate="1:1")


def test_compare_by_key(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 1.0)], "k int, x double")
    b = spark.createDataFrame([(1, 1.005), (2, 2.5), (3, None), (5, 1.0)], "k int, x double")
    assert sorted(column(compare_by_key(a, b, "k", {"x": 0.01}), "k")) == [2, 4, 5]


def test_spine_keeps_empty_labels(spark):
    spine = calendar.label_spine(spark, "v", ["x", "y"])
    found = spark.createDataFrame([("y", 2)], "v string, n int")
    assert rows(spine_join(spine, found, "v").orderBy("_order").select("v", "n")) == [
        ("x", None), ("y", 2)]


def _facts(spark, quotes):
    inquiries = spark.createDataFrame(
        [("I1", True, "D1"), ("I2", False, None)],
        "inquiry_id string, conversion_flag boolean, winning_dealer_id string")
    return inquiries, spark.createDataFrame(
        quotes, "inquiry_id string, dealer_id string, accepted_flag boolean")


def test_accepted_quote_rule(spark):
    good = [("I1", "D1", True), ("I1", "D2", False), ("I2", "D1", False)]
    assert accepted_quote_violations(*_facts(spark, good)).isEmpty()
    twice = [("I1", "D1", True), ("I1", "D2", True), ("I2", "D1", False)]
    assert column(accepted_quote_violations(*_facts(spark, twice)), "inquiry_id") == ["I1"]
    lost = [("I1", "D2", True), ("I2", "D1", True)]
    assert sorted(column(accepted_quote_violations(*_facts(spark, lost)), "inquiry_id")) == [
        "I1", "I2"]
