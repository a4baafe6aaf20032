"""Compiled key checks, declared constraints, top lists with ties and quantile sketches."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as registered
from marketlens.operators.checks import Reference, Unique, key_results
from marketlens.operators.joins import orphan_counts
from marketlens.operators.order_stats import units
from marketlens.operators.sketches import (
    RANK_ERROR, merged_sketches, quantile_sketches, sketch_percentiles,
)
from marketlens.operators.top import top_with_ties
from marketlens.plans import quality as Q
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
KEYS = st.lists(st.sampled_from([None, "a", "b", "c", ""]), max_size=8)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parents=KEYS, children=KEYS, others=KEYS)
def test_uniqueness_and_orphans_come_from_one_shuffle(spark, parents, children, others):
    tables = {
        "parent": spark.createDataFrame([(k,) for k in parents], "id string"),
        "child": spark.createDataFrame([(k, o) for k, o in zip(children, others)],
                                       "id string, other string"),
        "empty": spark.createDataFrame([], "id string")}
    found = {r.check: (r.passed, r.checked) for r in key_results(
        tables, [Unique("u", "parent", ("id",)), Unique("pair", "child", ("id", "other")),
                 Unique("none", "empty", ("id",))],
        [Reference("one", "child", ("id",), "parent", ("id",)),
         Reference("two", "child", ("other",), "parent", ("id",)),
         Reference("lost", "child", ("id",), "empty", ("id",))]).collect()}
    pairs = list(zip(children, others))
    assert found["u"] == (len(set(parents)), len(parents))
    assert found["pair"] == (len(set(pairs)), len(pairs)) and found["none"] == (0, 0)
    for check, used in (("one", [p[0] for p in pairs]), ("two", [p[1] for p in pairs])):
        assert found[check] == (sum(k is None or k in parents for k in used), len(used))
    assert found["lost"] == (sum(p[0] is None for p in pairs), len(pairs))


def test_keys_of_other_types_meet_in_the_parents_type(spark):
    tables = {"p": spark.createDataFrame([(1,), (2,)], "id int"),
              "c": spark.createDataFrame([("1",), ("02",), ("3",), ("x",), (None,)], "k string")}
    found = key_results(tables, [], [Reference("k", "c", ("k",), "p", ("id",))])
    assert rows(found) == [("reference", "k", 3, 5)]
    numeric = tables["c"].filter("k != 'x'")
    assert rows(orphan_counts(numeric, "k", tables["p"], "id")) == [(3, 2, 1)]


def test_quality_needs_two_scans_a_table_and_few_shuffles(spark):
    run = registered.run_for(spark, FOLDER)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = Q.quality_metrics(run.raw, run.curated)._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert text.count("FileScan") <= 24 and text.count("Exchange") <= 20
        assert "Join" not in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_broken_constraints_are_found(spark):
    from marketlens.constraints import schema_constraints
    tables = dict(registered.run_for(spark, FOLDER).tables())
    before = schema_constraints(tables).filter("passed < checked").collect()
    assert {(r.table_name, r.kind, r.check) for r in before} == {
        ("dim_customer", "not_null", "lead_source")}  # unmapped words, as in the raw rows
    bad = tables["fact_quote"].limit(3).withColumns({
        "dealer_id": F.lit("nobody"), "quote_rank": F.lit(0).cast("bigint"),
        "quote_amount": F.lit(None).cast("decimal(12,2)")})
    tables["fact_quote"] = tables["fact_quote"].unionByName(bad)
    broken = {(r.table_name, r.kind, r.check): r.checked - r.passed
              for r in schema_constraints(tables).filter(
                  "passed < checked and table_name != 'dim_customer'").collect()}
    assert broken == {
        ("fact_quote", "primary_key", "quote_id"): 3, ("fact_quote", "domain", "rank_positive"): 3,
        ("fact_quote", "reference", "dealer_id"): 3, ("fact_quote", "not_null", "quote_amount"): 3}


def test_facts_are_tagged_without_their_raw_rows(spark):
    run = registered.run_for(spark, FOLDER)
    for table in ("fact_inquiry", "fact_quote"):
        for tagged in run.cleaned.tagged[table]:
            assert not [c for c in tagged.columns if c.startswith("raw_") or c == "_payload"]
    late = run.quarantined_records.filter("table_name like 'fact%'")
    assert not late.isEmpty() and late.filter("record_payload is null").isEmpty()


@pytest.mark.parametrize("n", [1, 3, 50])
def test_top_keeps_the_ties_at_its_edge(spark, n):
    rng = random.Random(n)
    data = [(g, rng.choice([None, *range(6)])) for g in ("a", "b", None) for _ in range(20)]
    df = spark.createDataFrame(data, "g string, v int").withColumn("v", F.col("v").cast("decimal(5,1)"))
    want = []
    for group in ("a", "b", None):
        values = sorted((v for g, v in data if g == group and v is not None), reverse=True)
        want += [(group, v) for v in values if v >= values[:n][-1]]
    found = rows(top_with_ties(df, "v", 1, n, ["g"]))
    assert sorted(map(str, ((g, int(v)) for g, v in found))) == sorted(map(str, want))
    values = sorted((v for _, v in data if v is not None), reverse=True)
    assert top_with_ties(df, "v", 1, n).count() == sum(v >= values[:n][-1] for v in values)
    assert top_with_ties(df.limit(0), "v", 1, n, ["g"]).isEmpty()
    assert top_with_ties(df.filter("v is null"), "v", 1, n).isEmpty()


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5))
        .alias("g"), (F.col("id") % 7).alias("part"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 100).cast("decimal(12,2)").alias("v"))
    fine = quantile_sketches(df, ["g", "part"], "v", 2)
    assert fine.filter("octet_length(sketch) > 40000").isEmpty()
    for keys in (["g"], []):
        found = sketch_percentiles(merged_sketches(fine, keys), keys, 2,
                                   {"p10": (1, 10), "p50": (1, 2), "p99": (99, 100)})
        for r in found.collect():
            group = df if not keys else df.filter(F.col("g") == r.g)
            n = group.count()
            for name, share in (("p10", .1), ("p50", .5), ("p99", .99)):
                below = group.filter(units("v", 2) <= int(r[name] * 100)).count() / n
                assert abs(below - share) <= RANK_ERROR + 1 / n
    nothing = quantile_sketches(df.limit(0), ["g"], "v", 2)
    assert nothing.isEmpty()
