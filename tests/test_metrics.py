"""The metric layer: grains, filters, calendar shifts and ranks."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens.plans import queries as B
from marketlens.plans.metrics import MEASURES, REPORTS, evaluate, report

from tests.conftest import rows


@pytest.fixture(scope="module")
def tables(spark):
    days = [dt.date(2022, 1, 5), dt.date(2022, 1, 9), dt.date(2022, 2, 3), dt.date(2022, 4, 2)]
    inquiries = [
        (f"I{n}", "C1", f"V{n % 2}", day, "Direct" if n % 2 else "Partner", n in (0, 2),
         Decimal("100.00") if n in (0, 2) else None, 1 if n in (0, 2) else None,
         Decimal(n * 4 + 1))
        for n, day in enumerate(days)]
    quotes = [
        (f"Q{n}{d}", f"I{n}", f"D{d}", days[n] + dt.timedelta(days=30 * d), Decimal("100.00"),
         n in (0, 2) and d == 0, Decimal("80.00"), Decimal("1.2500"), Decimal("2.00"))
        for n in range(4) for d in range(3) if d < 2 or n < 2]
    money = "decimal(12,2)"
    return {
        "fact_inquiry": spark.createDataFrame(
            inquiries, "inquiry_id string, customer_id string, vehicle_id string, "
            "inquiry_date date, lead_source string, conversion_flag boolean, "
            f"final_sale_price {money}, days_to_conversion int, "
            "fastest_response_hours decimal(8,2)"),
        "fact_quote": spark.createDataFrame(
            quotes, "quote_id string, inquiry_id string, dealer_id string, quote_date date, "
            f"quote_amount {money}, accepted_flag boolean, estimated_market_value {money}, "
            "quote_to_market_ratio decimal(8,4), response_time_hours decimal(8,2)"),
        "dim_dealer": spark.createDataFrame(
            [("D0", "North", "A", True), ("D1", "South", "B", False), ("D2", "West", "B", True)],
            "dealer_id string, dealer_name string, dealer_region string, active_flag boolean"),
        "dim_vehicle": spark.createDataFrame(
            [("V0", "Suv"), ("V1", "Van")], "vehicle_id string, vehicle_type string"),
        "dim_date": spark.createDataFrame(
            [(dt.date(2022, 1, 1) + dt.timedelta(days=n),) for n in range(181)], "date date"),
    }


def one(df):
    return df.first().asDict()


def test_facts_are_not_multiplied(tables):
    found = one(evaluate(tables, ["total_inquiries", "total_quotes", "conversion_rate",
                                  "average_quotes_per_inquiry", "dealer_win_rate"]))
    assert found == {"total_inquiries": 4, "total_quotes": 10, "conversion_rate": 0.5,
                     "average_quotes_per_inquiry": 2.5, "dealer_win_rate": 0.2}


def test_dealer_filter_reaches_quotes_only(tables):
    found = one(evaluate(tables, ["total_inquiries", "total_quotes", "active_dealers"],
                         filters={"dealer_region": ["B"]}))
    assert found == {"total_inquiries": 4, "total_quotes": 6, "active_dealers": 1}


def test_vehicle_filter_reaches_both_facts(tables):
    found = one(evaluate(tables, ["total_inquiries", "total_quotes", "active_dealers"],
                         filters={"vehicle_type": ["Suv"]}))
    assert found == {"total_inquiries": 2, "total_quotes": 5, "active_dealers": 2}


def test_date_range_filter(tables):
    found = one(evaluate(tables, ["total_inquiries", "total_quotes"], filters={
        "date": (dt.date(2022, 1, 6), dt.date(2022, 2, 28))}))
    assert found == {"total_inquiries": 2, "total_quotes": 5}


def test_inquiry_measure_repeats_over_dealers(tables):
    found = rows(evaluate(tables, ["total_quotes", "total_inquiries"], ["dealer_id"])
                 .orderBy("dealer_id"))
    assert found == [("D0", 4, 4), ("D1", 4, 4), ("D2", 2, 4)]


def test_other_date_role(tables):
    found = {r.month_start.month: (r.total_quotes, r.total_quotes_by_quote_date)
             for r in evaluate(tables, ["total_quotes", "total_quotes_by_quote_date"],
                               ["month_start"]).collect()}
    assert found == {1: (6, 2), 2: (2, 3), 3: (None, 3), 4: (2, 1), 5: (None, 1)}


def test_calendar_shift_differs_from_row_offset(tables):
    found = {r.month_start.month: (r.total_inquiries, r.previous_month_inquiries,
                                   r.rolling_3m_conversion_rate)
             for r in evaluate(tables, ["total_inquiries", "previous_month_inquiries",
                                        "rolling_3m_conversion_rate"], ["month_start"]).collect()}
    assert found == {1: (2, None, 0.5), 2: (1, 2, 2 / 3), 3: (None, 1, 2 / 3),
                     4: (1, None, 0.5), 5: (None, 1, 0.0), 6: (None, None, 0.0)}
    by_row = {r.month.month: r.previous_month_inquiries for r in B.q16(tables).collect()}
    assert by_row == {1: None, 2: 2, 4: 1}


def test_shift_ignores_the_date_filter_of_its_month(tables):
    found = rows(evaluate(tables, ["total_inquiries", "previous_month_inquiries"],
                          ["month_start"], {"month_start": [dt.date(2022, 2, 1)]}))
    assert found == [(dt.date(2022, 2, 1), 1, 2)]


def test_shift_needs_months(tables):
    with pytest.raises(ValueError, match="month_start"):
        evaluate(tables, ["previous_month_inquiries"])


def test_dealer_rank_counts_only_eligible_dealers(tables):
    found = {r.dealer_id: (r.dealer_rank, r.dealer_win_rate_top_7, r.dealer_accepted_value_top_5)
             for r in evaluate(
                 tables, ["dealer_rank", "dealer_win_rate_top_7", "dealer_accepted_value_top_5"],
                 ["dealer_id", "dealer_name"], min_quotes=3).collect()}
    assert found == {"D0": (1, 0.5, Decimal("200.00")), "D1": (2, 0.0, None),
                     "D2": (None, None, None)}


def test_median_by_group(tables):
    found = {r.vehicle_type: float(r.median_quote) for r in evaluate(
        tables, ["median_quote", "total_quotes"], ["vehicle_type"]).collect()}
    assert found == {"Suv": 100.0, "Van": 100.0}


def test_all_measures_and_reports_are_declared():
    assert len(MEASURES) == 55 and len(REPORTS) == 20
    assert all(m in MEASURES for _, names, _ in REPORTS.values() for m in names)


def test_report_is_sorted(tables):
    found = [r.dealer_id for r in report(tables, "r13", min_quotes=3).select("dealer_id").collect()]
    assert found == ["D0", "D1", "D2"]


def test_unknown_names_are_refused(tables):
    with pytest.raises(ValueError, match="unknown.*colour"):
        evaluate(tables, ["total_inquiries"], ["colour"])
    with pytest.raises(ValueError, match="no measure reaches.*dealer_id"):
        evaluate(tables, ["total_inquiries"], ["dealer_id"])


def test_date_slicers_limit_the_months_shown(tables):
    found = rows(evaluate(tables, ["total_inquiries", "previous_month_inquiries"],
                          ["month_start", "year"],
                          {"date": (dt.date(2022, 2, 1), dt.date(2022, 3, 15)), "year": [2022]})
                 .orderBy("month_start"))
    assert found == [(dt.date(2022, 2, 1), 2022, 1, 2), (dt.date(2022, 3, 1), 2022, None, 1)]
    with pytest.raises(ValueError):
        evaluate(tables, ["previous_month_inquiries"], ["month_start", "date"])


def test_ranks_start_again_in_each_context(tables):
    found = rows(evaluate(tables, ["dealer_rank"], ["month_start", "dealer_id"], min_quotes=1)
                 .orderBy("month_start", "dealer_id"))
    assert [r[2] for r in found] == [1, 2, 2, 1, 2, 1, 1]
    with pytest.raises(ValueError):
        evaluate(tables, ["dealer_rank"], ["month_start"])


def test_missing_members_meet_and_unrelated_keys_are_refused(tables):
    blank = {**tables, "fact_inquiry": tables["fact_inquiry"].selectExpr(
        "* except (lead_source)", "cast(null as string) lead_source")}
    found = rows(evaluate(blank, ["total_quotes", "total_inquiries"],
                          ["lead_source", "dealer_id"]).orderBy("dealer_id"))
    assert found == [(None, "D0", 4, 4), (None, "D1", 4, 4), (None, "D2", 2, 4)]
    with pytest.raises(ValueError):
        evaluate(tables, ["active_dealers", "total_inquiries"], ["dealer_id", "lead_source"])


def _exchanges(plan):
    """(line, lines below it) of every exchange of a plan's text."""
    lines = [line for line in plan.split("\n") if line.strip()]
    depth = [re.search(r"[^ :+-]", line).start() for line in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield line, lines[i + 1:end]


@pytest.mark.parametrize("name", ["r04", "r05", "r13", "r14", "r15", "r16"])
def test_quotes_are_states_before_they_meet_dealers(spark, tables, tmp_path, name):
    from marketlens.plans.metrics import Base, _aggregate, _closure
    by, measures, _ = REPORTS[name]
    stored = {}
    for table, df in tables.items():
        path = str(tmp_path / table)
        df.withColumns({"dealer_rating": F.lit(1)} if table == "dim_dealer" else {}).write.parquet(
            path)
        stored[table] = spark.read.parquet(path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        direct = [m for m in _closure(measures) if isinstance(MEASURES[m], Base)]
        df = _aggregate(stored, direct, by, {})
        found = list(_exchanges(df._jdf.queryExecution().executedPlan().toString()))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    hot = [below for line, below in found if "dealer_id" in line
           and re.search("(accepted_flag|quote_amount|response_time_hours)#", "".join(below))]
    assert hot and all("HashAggregate" in below[0] for below in hot)


def test_states_equal_one_aggregate_over_joined_rows(tables):
    from marketlens.operators import states as S
    quotes = tables["fact_quote"].join(tables["dim_dealer"], "dealer_id")
    measures = {"n": S.rows(), "mean": S.mean("quote_amount", lambda: F.col("accepted_flag")),
                "least": S.least("quote_date"), "won": S.count_where(lambda: F.col("accepted_flag")),
                "sum": S.total(lambda: F.col("quote_amount")),
                "last": S.greatest(lambda: F.col("quote_date"))}
    once = S.finished(S.partial(quotes, ["dealer_region"], measures), ["dealer_region"], measures)
    states = S.partial(quotes, ["dealer_id", "quote_date", "dealer_region"], measures)
    for keys in (["quote_date", "dealer_region"], ["dealer_region"]):
        states = S.merged(states, keys, measures)
    again = S.finished(states, ["dealer_region"], measures)
    assert again.schema == once.schema
    assert sorted(rows(again)) == sorted(rows(once))
    none = S.merged(S.partial(quotes.filter("false"), ["dealer_id"], measures), [], measures)
    assert one(S.finished(none, [], measures)) == {
        "n": 0, "mean": None, "least": None, "won": 0, "sum": None, "last": None}
