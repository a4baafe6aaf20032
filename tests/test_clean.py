"""The cleaning waterfall on hand-made tables."""

import json

import pytest
from pyspark.sql import functions as F

from marketlens.plans import quality as Q
from marketlens.plans.audits import AUDITS
from marketlens.plans.pipeline import Run
from marketlens.schema import KEYS

from tests.conftest import column, rows
from tests.fixtures import DEFECTS, MINI, raw_frames


@pytest.fixture(scope="module")
def mini(spark):
    catalog = spark.createDataFrame([("Volkswagen", "Golf", "Hatchback")],
                                    "brand string, model string, vehicle_type string")
    return Run(spark, raw_frames(spark), "mini", catalog)


@pytest.fixture(scope="module")
def defects(spark):
    return Run(spark, raw_frames(spark, DEFECTS), "defects")


def issues(run):
    return {(r.table_name, r.issue_type): r.affected_rows for r in run.issue_log.collect()}


def test_mini_corrections(mini):
    customer = mini.curated["dim_customer"].collect()
    assert [(c.customer_id, c.canton, c.lead_source) for c in customer] == [
        ("C000001", "Unknown", "Dealer Referral")]
    vehicle = mini.curated["dim_vehicle"].first()
    assert (vehicle.brand, vehicle.mileage_km) == ("Volkswagen", 5000)
    found = issues(mini)
    for issue in (("dim_customer", "duplicate_primary_key"), ("dim_customer", "missing_canton"),
                  ("dim_vehicle", "negative_mileage_sign_error"),
                  ("fact_inquiry", "winning_dealer_mismatch")):
        assert found[issue] == 1


def test_mini_enrichment(mini):
    inquiry = mini.curated["fact_inquiry"].first()
    assert (inquiry.winning_dealer_id, inquiry.quote_count, float(inquiry.quote_spread),
            inquiry.vehicle_age_at_inquiry, inquiry.status) == (
        "D0001", 2, 2000.0, 2, "Converted")
    quote = mini.curated["fact_quote"].filter("quote_id = 'Q00000002'").first()
    assert (float(quote.response_time_hours), float(quote.quote_to_market_ratio),
            quote.anomaly_flag, quote.quote_rank) == (4.0, 0.88, False, 2)
    mini.verify()


def test_metric_rates_reconcile(mini):
    for row in mini.quality_metrics.collect():
        assert row.rate == row.passed_records / row.total_records
    overall = mini.quality_metrics.groupBy("stage").agg(
        F.sum(F.when(F.col("metric_name") == "overall_data_quality_score",
                     F.col("passed_records"))).alias("overall"),
        F.sum(F.when(F.col("metric_name") != "overall_data_quality_score",
                     F.col("passed_records"))).alias("parts"))
    assert all(r.overall == r.parts for r in overall.collect())


def test_each_defect_is_charged_to_the_first_rule(defects):
    found = {(r.table_name, r.record_id, r.issue_type)
             for r in defects.quarantined_records.collect()}
    assert found == {
        ("dim_customer", "C1", "duplicate_primary_key"),
        ("dim_customer", "C2", "malformed_customer_date"),
        ("dim_vehicle", "V1", "invalid_vehicle_domain"),
        ("dim_vehicle", "V3", "invalid_vehicle_domain"),
        ("dim_vehicle", "V4", "duplicate_primary_key"),
        ("dim_dealer", "D2", "invalid_dealer_rating"),
        ("fact_inquiry", "I1", "duplicate_primary_key"),
        ("fact_inquiry", "I2", "malformed_inquiry_date"),
        ("fact_inquiry", "I3", "invalid_inquiry_foreign_key"),
        ("fact_inquiry", "I4", "invalid_inquiry_foreign_key"),
        ("fact_inquiry", "I5", "customer_date_sequence"),
        ("fact_inquiry", "I7", "inquiry_without_quote"),
        ("fact_quote", "Q1", "duplicate_primary_key"),
        ("fact_quote", "Q3", "quote_date_sequence"),
        ("fact_quote", "Q4", "invalid_quote_domain"),
        ("fact_quote", "Q5", "invalid_quote_domain"),
        ("fact_quote", "Q6", "invalid_quote_domain"),
        ("fact_quote", "Q7", "invalid_quote_foreign_key"),
        ("fact_quote", "Q8", "invalid_quote_foreign_key"),
        ("fact_quote", "Q9", "invalid_quote_foreign_key"),
        ("dim_date", "2022-03-01", "invalid_date_dimension_key"),
        ("dim_date", "<NULL>", "invalid_date_dimension_key"),
    }


def test_corrections_are_counted(defects):
    found = issues(defects)
    assert {k: v for k, v in found.items() if k[1] not in {
        r.issue_type for r in defects.quarantined_records.select("issue_type").collect()}} == {
        ("dim_customer", "missing_canton"): 1,
        ("dim_customer", "inconsistent_lead_source_text"): 1,
        ("dim_vehicle", "missing_fuel_type"): 2,
        ("dim_dealer", "dealer_name_whitespace"): 1,
        ("fact_inquiry", "accepted_quote_removed_by_quality_rule"): 2,
        ("fact_quote", "missing_response_time"): 1,
        ("fact_quote", "accepted_quote_without_conversion"): 3,
        ("fact_quote", "quote_to_market_anomaly"): 1,
    }


def test_payload_keeps_the_original_text(defects):
    payload = {r.record_id: json.loads(r.record_payload) for r in
               defects.quarantined_records.filter("table_name <> 'dim_date'").collect()}
    assert payload["C2"]["customer_created_date"] == "2025-99-41"
    assert payload["I2"]["inquiry_date"] == "not-a-date"
    assert payload["I7"]["status"] == "open"
    assert payload["Q4"]["quote_date"] == "soon"
    assert payload["I3"]["winning_dealer_id"] == "<NULL>"
    assert list(payload["Q4"]) == sorted(payload["Q4"])


def test_quarantine_ids_are_consecutive(defects):
    ids = sorted(column(defects.quarantined_records, "quarantine_id"))
    assert ids == [f"QR{n:07d}" for n in range(1, len(ids) + 1)]


def test_dimension_values(defects):
    customer = {r.customer_id: r for r in defects.curated["dim_customer"].collect()}
    assert customer["C1"].lead_source == "Paid Search" and customer["C1"].canton == "ZH"
    assert customer["C3"].age_group == "65+ X-Y" and customer["C3"].lead_source is None
    vehicle = {r.vehicle_id: r for r in defects.curated["dim_vehicle"].collect()}
    assert (vehicle["V2"].mileage_km, float(vehicle["V2"].estimated_market_value),
            vehicle["V2"].fuel_type, vehicle["V2"].vehicle_type, vehicle["V2"].brand,
            vehicle["V2"].mileage_bracket, vehicle["V2"].market_value_band) == (
        25000, 25000.0, "Unknown", "Suv", "Bmw", "0-25k", "25k-50k")
    assert (vehicle["V4"].mileage_bracket, vehicle["V4"].market_value_band) == (
        "25k-75k", "80k+")
    dealer = {r.dealer_id: r for r in defects.curated["dim_dealer"].collect()}
    assert (float(dealer["D1"].dealer_rating), dealer["D1"].dealer_name,
            dealer["D1"].active_flag, dealer["D3"].active_flag) == (4.56, "North", True, False)


def test_outcomes_agree_on_both_facts(defects):
    inquiry = {r.inquiry_id: r for r in defects.curated["fact_inquiry"].collect()}
    assert set(inquiry) == {"I1", "I6", "I8", "I9"}
    assert (inquiry["I1"].status, float(inquiry["I1"].final_sale_price),
            inquiry["I1"].winning_dealer_id, inquiry["I1"].days_to_conversion) == (
        "Converted", 20000.0, "D1", 3)
    for key in ("I6", "I8"):  # the accepted quote was rejected; two quotes were accepted
        assert (inquiry[key].status, inquiry[key].conversion_flag, inquiry[key].final_sale_price,
                inquiry[key].winning_dealer_id, inquiry[key].days_to_conversion) == (
            "Lost", False, None, None, None)
    accepted = defects.curated["fact_quote"].filter("accepted_flag")
    assert column(accepted, "quote_id") == ["Q1"]
    defects.verify()
    assert rows(Q.cross_fact_checks(defects.curated).select("reconciles")) == [(True,)]


def test_rank_ties_follow_source_order_and_gaps_take_the_median(defects):
    quote = {r.quote_id: r for r in defects.curated["fact_quote"].collect()}
    assert (quote["Q1"].quote_rank, quote["Q2"].quote_rank) == (1, 2)
    assert float(quote["Q2"].response_time_hours) == 8.0  # median of 0, 8 and 10 for D3
    assert quote["Q13"].anomaly_flag and float(quote["Q13"].quote_to_market_ratio) == 6.25


def test_rows_are_kept_or_quarantined(defects):
    summary = {r.table_name: r for r in defects.run_summary.collect()}
    rejected = {r.table_name: r["count"] for r in
                defects.quarantined_records.groupBy("table_name").count().collect()}
    for table, raw in DEFECTS.items():
        assert summary[table].raw_records == len(raw)
        assert len(raw) == summary[table].clean_records + rejected.get(table, 0)
    assert summary["fact_inquiry"].duplicate_records == 1
    assert summary["fact_quote"].corrected_records == 4


def test_audits_find_nothing_in_clean_tables(defects):
    tables = defects.tables()
    for name, audit in AUDITS.items():
        if name != "d10":
            assert all(v == 0 for row in rows(audit(tables)) for v in row
                       if isinstance(v, int)), name


def test_checks_fail_with_the_names(defects):
    tables = dict(defects.curated)
    tables["fact_quote"] = tables["fact_quote"].withColumn("dealer_id", F.lit("D9"))
    with pytest.raises(ValueError, match="accepted_quote_rule.*quote_dealer_fk"):
        Q.assert_checks(Q.run_checks(tables))


def test_constraints_and_calendar(defects):
    assert all(r.passed == r.checked for r in Q.constraint_checks(defects.curated).collect())
    assert all(r.failures == 0 for r in Q.calendar_checks(defects.curated).collect())
    tables = dict(defects.curated)
    tables["dim_date"] = tables["dim_date"].filter("date <> '2022-03-10'")
    assert {r.check_name: r.failures for r in Q.calendar_checks(tables).collect()}[
        "missing_days"] == 1


def test_cleaning_its_own_output_rejects_nothing(spark, mini):
    again = {name: mini.curated[name].select(
        *[F.col(c).cast("string").alias(c) for c in mini.curated[name].columns],
        F.col(KEYS[name]).alias("_ordinal")) for name in MINI}
    second = Run(spark, again, "mini-again")
    assert second.quarantined_records.isEmpty()
    for name in MINI:
        # Cantons are codes and upper-cased, so the word for a missing one comes back as UNKNOWN.
        first, again = (run.curated[name].drop("canton") for run in (mini, second))
        assert sorted(map(str, rows(again))) == sorted(map(str, rows(first)))
