"""Source orders of different shapes under one key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions.ordinals import source_key


def test_keys_sort_as_the_ordinals(spark):
    days = [dt.date(2024, 1, 9), None, dt.date(1969, 5, 1)]
    frames = [
        spark.createDataFrame([(n,) for n in (10, 9, 199, -3, None)], "_ordinal long"),
        spark.createDataFrame([((f, b, r),) for f in ("b", "a") for b in (100, 20) for r in (9, 10)],
                              "_ordinal struct<file: string, block: long, row: long>"),
        spark.createDataFrame([((d, p),) for d in days for p in (2, 11)],
                              "_ordinal struct<day: date, part: int>"),
    ]
    kinds = set()
    for df in frames:
        keyed = df.withColumn("k", source_key(df))
        kinds.add(keyed.schema["k"].dataType.simpleString())
        assert [r._ordinal for r in keyed.orderBy("k").collect()] == [
            r._ordinal for r in keyed.orderBy("_ordinal").collect()]
    assert len(kinds) == 1


def test_other_types_are_refused(spark):
    df = spark.range(1).select(F.array("id").alias("_ordinal"))
    with pytest.raises(TypeError):
        source_key(df)


def test_quarantine_follows_the_source(spark):
    import __spark_entry__ as registered
    found = registered.queries()["quarantine"](spark, "/root/testdata/sf0.001").where(
        "issue_type = 'invalid_vehicle_domain'").orderBy("quarantine_id").collect()
    numbers = [int(r.record_id[1:]) for r in found]
    assert numbers == sorted(numbers) != sorted(numbers, key=str)
    assert all('"vehicle_id":"' + r.record_id + '"' in r.record_payload for r in found)


def test_rejects_are_numbered_by_table_and_across_ordinals(spark):
    from marketlens.plans.clean import Cleaned
    from marketlens.plans.quality import TABLE_ORDER, quarantined_records
    from marketlens.schema import KEYS, MALFORMED_RULE, REJECT_RULES
    from marketlens.session import Workspace

    def rejects(table, rule, ordinals, kind):
        return spark.createDataFrame(
            [(f"{rule[:3]}{i}", rule, o, "{}") for i, o in enumerate(ordinals)],
            f"{KEYS[table]} string, _rule string, _ordinal {kind}, _payload string")

    frames = {table: [rejects(table, next(iter(REJECT_RULES[table])), [30, 4, 100], "long")]
              for table in TABLE_ORDER}
    frames["dim_dealer"].append(rejects("dim_dealer", MALFORMED_RULE, [("b", 9), ("b", 10), ("a", 7)],
                                        "struct<file: string, row: long>"))
    space = Workspace(spark, "numbers")
    found = quarantined_records(Cleaned({}, rejects=frames), space).orderBy("quarantine_id").collect()
    assert [r.quarantine_id for r in found] == [f"QR{n:07d}" for n in range(1, 22)]
    assert list(dict.fromkeys(r.table_name for r in found)) == TABLE_ORDER
    for table in TABLE_ORDER:
        numbers = [r.record_id[3:] for r in found
                   if r.table_name == table and r.issue_type != MALFORMED_RULE]
        assert numbers == ["1", "0", "2"]
    assert [r.record_id[3:] for r in found if r.issue_type == MALFORMED_RULE] == ["2", "0", "1"]


def test_rejected_quotes_need_no_lookup(spark):
    import __spark_entry__ as registered
    cleaned = registered.run_for(spark, "/root/testdata/sf0.001").cleaned
    (quotes,) = cleaned.rejects["fact_quote"]
    assert "_payload" in quotes.columns and not quotes.isEmpty()
    assert quotes.filter("_payload is null").isEmpty()
