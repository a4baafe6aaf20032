"""Readers and writers."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.plans import evidence as E
from marketlens.plans.pipeline import Run, run
from marketlens.plans.views import register_views
from marketlens.schema import LOAD_ORDER, RAW_COLUMNS
from marketlens.sources import curated as C
from marketlens.sources import raw as R

from tests.conftest import column, rows
from tests.fixtures import MINI, raw_frames


@pytest.fixture(scope="module")
def csv_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for table, data in MINI.items():
        with open(folder / f"{table}.csv", "w", newline="") as handle:
            writer = csv.writer(handle)
            writer.writerow([" Customer ID "] + RAW_COLUMNS[table][1:]
                            if table == "dim_customer" else RAW_COLUMNS[table])
            writer.writerows([["N/A" if v is None else v for v in row] for row in data])
    with open(folder / "catalog.csv", "w", newline="") as handle:
        csv.writer(handle).writerows([["brand", "model", "vehicle_type"],
                                      ["Volkswagen", "Golf", "Hatchback"]])
    return str(folder)


@pytest.fixture(scope="module")
def tables(spark):
    return Run(spark, raw_frames(spark), "sources").tables()


def text(df):
    return sorted(map(str, rows(df)))


def test_raw_csv_is_text_with_nulls_and_order(spark, csv_folder):
    counts = {}
    raw = R.read_raw(spark, csv_folder, counts)
    customers = sorted(raw["dim_customer"].collect(), key=lambda c: c._ordinal)
    assert [(c.customer_id, c.canton) for c in customers] == [
        ("C000001", None), ("C000001", "ZH")]
    assert counts["dim_customer"].get["rows"] == 2
    assert {t for c, t in raw["fact_quote"].dtypes if c != "_ordinal"} == {"string"}


def test_missing_input_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="dim_date.csv"):
        R.read_raw(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="run the cleaning pipeline first"):
        C.read_tables(spark, str(tmp_path))


def test_end_to_end_from_csv(spark, csv_folder, tmp_path, tables):
    run(spark, csv_folder, str(tmp_path / "out"), f"{csv_folder}/catalog.csv")
    found = C.read_published(spark, str(tmp_path / "out"))
    assert set(found) == set(LOAD_ORDER)
    for name in ("dim_dealer", "fact_inquiry", "fact_quote", "data_quality_issue_log"):
        assert text(found[name]) == text(C.typed(tables[name], name)), name


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_round_trip(spark, tables, tmp_path, kind):
    C.write_tables(tables, str(tmp_path), kind)
    back = C.read_tables(spark, str(tmp_path), kind)
    for name in LOAD_ORDER:
        assert back[name].dtypes == C.typed(tables[name], name).dtypes
        assert text(back[name]) == text(C.typed(tables[name], name)), name


def test_partitioned_write_prunes(spark, tables, tmp_path):
    C.write_tables({"fact_quote": tables["fact_quote"]}, str(tmp_path),
                   partition_by={"fact_quote": ["quote_date"]})
    df = spark.read.parquet(f"{tmp_path}/fact_quote").filter("quote_date = '2022-01-02'")
    assert column(df, "quote_id") == ["Q00000002"]
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().toString()


def test_publish_shows_only_complete_versions(spark, tables, tmp_path):
    C.publish(tables, str(tmp_path), "2026-01-01")
    C.write_tables({"dim_date": tables["dim_date"].limit(0)},
                   f"{tmp_path}/versions/2026-01-02")  # a run that died half-way
    found = C.read_published(spark, str(tmp_path))
    assert found["dim_date"].count() == 2
    assert set(column(found["pipeline_run_summary"], "load_status")) == {"Loaded"}
    assert all(r.loaded_records == r.clean_records
               for r in found["pipeline_run_summary"].collect())


def test_versions_follow_by_time_and_are_never_replaced(spark, tables, tmp_path):
    C.publish(tables, str(tmp_path), "v9")
    C.publish({**tables, "dim_date": tables["dim_date"].limit(1)}, str(tmp_path), "v10")
    assert C.read_published(spark, str(tmp_path))["dim_date"].count() == 1
    with pytest.raises(ValueError):
        C.publish(tables, str(tmp_path), "v9")
    broken = {**tables, "fact_quote": tables["fact_quote"].withColumn(
        "quote_amount", F.raise_error(F.lit("disk full")).cast("decimal(12,2)"))}
    with pytest.raises(Exception, match="disk full"):
        C.publish(broken, str(tmp_path), "v11")
    assert C.read_published(spark, str(tmp_path))["dim_date"].count() == 1


def test_catalogue_tables_join_without_shuffle(spark, tables):
    C.save_tables(spark, tables, "market_test", {
        "fact_inquiry": (4, "inquiry_id"), "fact_quote": (4, "inquiry_id")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("market_test.fact_quote").join(
            spark.table("market_test.fact_inquiry"), "inquiry_id")
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
        assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(C.create_table_sql("market_test", "dim_date").replace("dim_date", "dim_empty", 1))
    assert spark.table("market_test.dim_empty").columns[0] == "date"


def test_views_answer_sql(spark, tables):
    register_views(spark, tables)
    assert rows(spark.sql(
        "SELECT dealer_id, total_quotes FROM vw_dealer_performance ORDER BY 1")) == [
        ("D0001", 1), ("D0002", 1)]


def test_payload_as_variant(tables):
    found = C.with_json_payload(tables["quarantined_records"]).select(
        F.variant_get("record_payload", "$.canton", "string").alias("canton"))
    assert column(found, "canton") == ["ZH"]


def test_evidence_files(spark, tables, tmp_path):
    chosen = {"kpis": E.kpis(tables), "monthly": E.monthly(tables)}
    C.write_evidence(chosen, str(tmp_path))
    month = spark.read.json(f"{tmp_path}/monthly").first()
    assert (month["month"], month["inquiries"]) == ("2022-01-01", 1)
    kpis = spark.read.option("header", True).csv(f"{tmp_path}/analysis_kpis")
    assert dict(rows(kpis))["total_quotes"] == "2.0"


def test_region_lookup(spark, csv_folder, tmp_path):
    (tmp_path / "regions.csv").write_text("canton,dealer_region\nZH,Zurich\n")
    regions = R.read_regions(spark, str(tmp_path / "regions.csv"))
    customers = spark.createDataFrame([("ZH",), ("Unknown",)], "canton string")
    assert sorted(rows(R.with_region(customers, regions))) == [
        ("Unknown", None), ("ZH", "Zurich")]


def test_curated_dates_are_dates(tables):
    assert tables["dim_date"].agg(F.min("date")).first()[0] == dt.date(2022, 1, 1)


def test_records_across_lines_and_malformed_records(spark, csv_folder, tmp_path):
    import json
    import shutil
    folder = tmp_path / "raw"
    shutil.copytree(csv_folder, folder)
    path = folder / "dim_dealer.csv"
    dealer = ["D0077", "Garage\nof \"Two, Lines\"\r\nand more", "Zurich", "Broker", "4.0", "yes"]
    with open(path, "a", newline="") as handle:
        csv.writer(handle).writerow(dealer)
        handle.write("D0078,too,few\r\n")
        handle.write("D0079,too,many,Broker,4.0,yes,7,8\r\n")
        csv.writer(handle).writerow(["D0080", "Last", "Bern", "Broker", "3.0", "no"])
    found = sorted(R.read_raw_table(spark, str(path), "dim_dealer").collect(),
                   key=lambda r: r._ordinal)
    ids = [r.dealer_id for r in found]
    assert ids[-4:] == ["D0077", "D0078", "D0079", "D0080"]
    dealer[1] = dealer[1].replace("\r\n", "\n")
    assert list(found[-4])[:6] == dealer and found[-4]._malformed is None
    assert [r._malformed is not None for r in found[-4:]] == [False, True, True, False]
    job = run(spark, str(folder), str(tmp_path / "out"), f"{csv_folder}/catalog.csv")
    assert {"D0077", "D0080"} <= set(column(job.curated["dim_dealer"], "dealer_id"))
    assert not {"D0078", "D0079"} & set(column(job.curated["dim_dealer"], "dealer_id"))
    kept = [json.loads(r.record_payload)["record"] for r in job.quarantined_records.filter(
        "issue_type = 'malformed_record'").orderBy("quarantine_id").collect()]
    assert [k.strip() for k in kept] == ["D0078,too,few", "D0079,too,many,Broker,4.0,yes,7,8"]
    summary = job.run_summary.filter("table_name = 'dim_dealer'").first()
    assert summary.raw_records == summary.clean_records + 2
