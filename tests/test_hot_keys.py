"""Keys of any size: the window for usual keys and the way of hot buckets give the same rows."""

import re

from pyspark.sql import functions as F

from marketlens.operators.dedupe import flag_later_copies, flag_stored_copies
from marketlens.operators.hot import copies_stay_within, hot_buckets
from marketlens.operators.joins import unknown_keys
from marketlens.operators.numbering import number_groups
from marketlens.plans.clean import impute_response, tag_quotes, with_payload
from marketlens.schema import QUOTE_BUCKETS
from marketlens.session import Workspace, buckets_for
from marketlens.sources import star

from tests.conftest import rows

SMALL = "/root/testdata/sf0.001"


def copies(spark):
    data = [(f"k{i % 40}" if i % 3 else "hot", i * 7919 % 1000, i) for i in range(900)]
    data += [(None, i, 1000 + i) for i in range(60)]
    return spark.createDataFrame(data, "k string, _ordinal long, i long")


def wide_shuffles(df, column):
    """Shuffles of the plan, before it runs, that carry the column."""
    text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    found = 0
    for at in re.finditer(r"Exchange hashpartitioning", text):
        below = text[at.end():].split("\n", 2)
        found += f"{column}#" in "\n".join(below[1:2])
    return found


def test_hot_and_usual_keys_are_flagged_alike(spark):
    df = copies(spark)
    assert hot_buckets(df, ["k"], 100) and not hot_buckets(df, ["k"], 1000)
    expected = sorted(rows(flag_later_copies(df, ["k"]).select("i", "_later_copy")))
    for limit in (10, 100, 1000):
        found = flag_stored_copies(df, ["k"], limit=limit).select("i", "_later_copy")
        assert sorted(rows(found)) == expected


def test_numbers_of_hot_and_usual_groups(spark):
    df = copies(spark)
    order = [F.col("_ordinal").desc(), F.col("i")]
    found = []
    for limit in (10, 100, 1000):
        numbered = number_groups(Workspace(spark, "hot"), df, "slices", "k", order, "n",
                                 hot_buckets(df, ["k"], limit))
        found.append(sorted(rows(numbered.select("i", "n"))))
    assert found[0] == found[1] == found[2] and len(found[0]) == 960


def test_copies_that_leave_their_group_are_noticed(spark):
    def within(*pairs, limit=100):
        return copies_stay_within(spark.createDataFrame(pairs, "k string, g string"), "k", "g", limit)

    assert within(("a", "x"), ("a", "x"), ("b", "y"), (None, None), (None, None))
    assert not within(("a", "x"), ("a", "y"))
    assert not within((None, "x"), (None, None))
    assert not within(*[("a", "x")] * 20, limit=10)


def test_unknown_keys_leave_out_null(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "f string")
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(unknown_keys(child, "f", parent, "p")) == [("b",)]


def test_order_lines_of_hot_and_usual_orders(spark):
    usual = star.order_lines(spark, SMALL)
    hot = star.order_lines(spark, SMALL, limit=4)
    assert sorted(rows(hot), key=str) == sorted(rows(usual.select(hot.columns)), key=str)
    best = usual.filter("_best").count()
    assert best == usual.select("l_orderkey").distinct().count()


def test_quotes_are_tagged_in_one_wide_shuffle(spark):
    lines = Workspace(spark, "one-shuffle").stage(star.order_lines(spark, SMALL), "lines")
    raw = star.quotes(lines)
    inquiries = raw.select(F.col("inquiry_id")).distinct().withColumn(
        "inquiry_date", F.date_sub(F.lit("1996-01-01").cast("date"), 0))
    dealers = spark.createDataFrame([(f"D{i}",) for i in range(0, 200, 2)], "dealer_id string")
    one = tag_quotes(raw, inquiries, dealers)
    several = tag_quotes(raw, inquiries, dealers, limit=3)
    assert sorted(rows(one), key=str) == sorted(rows(several), key=str)
    assert one.filter("_rule = 'duplicate_primary_key'").count() > 0
    assert wide_shuffles(one, "_ordinal") <= 1 < wide_shuffles(several, "_ordinal")


def test_bucketed_quotes_are_tagged_and_filled_where_they_lie(spark):
    space = Workspace(spark, "buckets")
    plain = star.quotes(space.stage(star.order_lines(spark, SMALL).drop(QUOTE_BUCKETS), "lines"))
    keyed = star.quotes(star.order_lines(spark, SMALL, workspace=space))
    assert sorted(rows(keyed.select(plain.columns)), key=str) == sorted(rows(plain), key=str)
    inquiries = plain.select("inquiry_id").distinct().withColumn(
        "inquiry_date", F.lit("1996-01-01").cast("date"))
    dealers = spark.createDataFrame([(f"D{i}",) for i in range(0, 200, 2)], "dealer_id string")
    tagged = tag_quotes(keyed, inquiries, dealers)
    late = tag_quotes(plain, inquiries, dealers)
    assert wide_shuffles(tagged, "_ordinal") == 0
    same = [c for c in late.columns if c != "inquiry_id"]
    assert sorted(rows(tagged.select(same)), key=str) == sorted(rows(late.select(same)), key=str)
    looked_up = with_payload(late.filter("_rule is not null"), plain, "fact_quote")
    found = tagged.filter("_rule is not null").select("_ordinal", "_payload")
    assert sorted(rows(found), key=str) == sorted(rows(looked_up.select(found.columns)), key=str)

    n = buckets_for(keyed)
    stored = space.stage(tagged, "tagged", "inquiry_id", n)
    passing = stored.filter("_rule is null").drop("_payload")
    filled = space.stage(impute_response(passing, n), "filled", "inquiry_id", n, placed=True)
    expected = impute_response(late.filter("_rule is null"))
    assert sorted(rows(filled), key=str) == sorted(rows(expected.select(filled.columns)), key=str)
    per_inquiry = filled.groupBy("inquiry_id").agg(F.count("quote_id").alias("n"))
    assert "Exchange" not in per_inquiry._jdf.queryExecution().executedPlan().toString()
    again = filled.groupBy("inquiry_id").agg(F.count("quote_id").alias("n")).collect()
    want = expected.groupBy("inquiry_id").agg(F.count("quote_id").alias("n")).collect()
    assert sorted(again, key=str) == sorted(want, key=str)


def test_orders_with_a_hot_one_are_not_bucketed(spark):
    space, other = Workspace(spark, "hot-lines"), Workspace(spark, "usual-lines")
    hot = star.order_lines(spark, SMALL, limit=4, workspace=space)
    usual = star.order_lines(spark, SMALL, workspace=other)
    assert QUOTE_BUCKETS not in hot.columns and not space.bucketed and other.bucketed
    a, b = star.quotes(hot), star.quotes(usual)
    assert sorted(rows(a), key=str) == sorted(rows(b.select(a.columns)), key=str)
