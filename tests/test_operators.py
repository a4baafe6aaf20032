"""Distributed order statistics, ranks and numbering against brute force."""

import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.operators.dedupe import flag_later_copies, keep_first
from marketlens.operators.numbering import number_within, range_numbered
from marketlens.operators.order_stats import (
    exact_percentiles, several_ranks, tile_summary, value_ranks,
)
from marketlens.operators.profile import correlations, field_profile, histogram, missing_shares
from marketlens.session import Workspace

from tests.conftest import rows


def skewed(seed, n=600):
    """Group `hot` holds a third of the rows, and one value a third of those."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        cents = 500 if rng.random() < 0.3 else rng.randrange(1, 5_000_000)
        data.append((i, group, cents))
    return data


def frame(spark, data):
    return spark.createDataFrame(data, "id long, g string, c long").withColumn(
        "v", (F.col("c").cast("decimal(12,0)") / 100).cast("decimal(12,2)"))


def interpolated(values, fraction):
    ordered = sorted(values)
    place = fraction * (len(ordered) - 1)
    low = place.numerator // place.denominator
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (place - low)


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_by_group(spark, seed):
    data = skewed(seed)
    found = {r.g: r for r in exact_percentiles(
        frame(spark, data), ["g"], "v", 2, {"p50": (1, 2), "p90": (9, 10), "p25": (1, 4)},
        size="n").collect()}
    for group in {g for _, g, _ in data}:
        cents = [c for _, g, c in data if g == group]
        assert found[group].n == len(cents)
        for name, fraction in (("p50", Fraction(1, 2)), ("p90", Fraction(9, 10)),
                               ("p25", Fraction(1, 4))):
            assert Fraction(str(found[group][name])) * 100 == interpolated(cents, fraction)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40))
def test_percentile_of_any_list(spark, cents):
    df = frame(spark, [(i, "x", c) for i, c in enumerate(cents)])
    found = exact_percentiles(df, [], "v", 2, {"m": (1, 2)}).first()[0]
    assert Fraction(str(found)) * 100 == interpolated(cents, Fraction(1, 2))


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_over_all_rows(spark, descending):
    data = [(i, g, c % 40) for i, g, c in skewed(3, 200)]
    df = frame(spark, data)
    ordered = sorted((c for _, _, c in data), reverse=descending)
    distinct = sorted(set(ordered), reverse=descending)
    for method in ("rank", "dense_rank", "percent_rank"):
        for r in value_ranks(df, "c", "r", method, descending).collect():
            place = ordered.index(r.c)
            expected = {"rank": place + 1, "dense_rank": distinct.index(r.c) + 1,
                        "percent_rank": place / (len(data) - 1)}[method]
            assert r.r == expected


def test_several_ranks_at_once(spark):
    data = [(i, g, c % 40) for i, g, c in skewed(4, 100)]
    found = several_ranks(frame(spark, data), "id", {
        "x": F.col("c"), "y": -F.col("c")}).collect()
    up = sorted(c for _, _, c in data)
    down = sorted(-c for _, _, c in data)
    by_id = {i: c for i, _, c in data}
    assert len(found) == len(data)
    assert all(r.x == up.index(by_id[r.id]) + 1 and r.y == down.index(-by_id[r.id]) + 1
               for r in found)


@pytest.mark.parametrize("n", [3, 10, 101])
def test_tiles(spark, n):
    rng = random.Random(n)
    data = [(i, "x", rng.choice([100, 100, 250, rng.randrange(1, 900)])) for i in range(n)]
    df = frame(spark, data).withColumn("won", F.col("id") % 3 == 0)
    ordered = sorted((c, i % 3 == 0) for i, _, c in data)
    size, extra = divmod(n, 4)
    start, expected = 0, []
    for tile in range(4):
        part = ordered[start:start + size + (tile < extra)]
        start += len(part)
        if part:
            expected.append((tile + 1, len(part), part[0][0] / 100, part[-1][0] / 100,
                             sum(won for _, won in part)))
    found = [(a, b, float(c), float(d), e) for a, b, c, d, e in rows(
        tile_summary(df, 4, "v", 2, "won", "tile").orderBy("tile"))]
    assert found == expected


def test_numbering_by_range_slices(spark):
    df = frame(spark, skewed(5))
    workspace = Workspace(spark, "test-numbering")
    found = range_numbered(workspace, df, "all", [F.col("c").desc(), F.col("id")], "n")
    ordered = [i for i, _, _ in sorted(skewed(5), key=lambda r: (-r[2], r[0]))]
    assert [r.id for r in found.orderBy("n").collect()] == ordered
    assert [r.n for r in found.orderBy("n").collect()] == list(range(1, len(ordered) + 1))


def test_running_totals_over_any_range(spark, monkeypatch):
    from marketlens.operators import order_stats
    monkeypatch.setattr(order_stats, "BLOCK", 16)
    data = [(k, (i * 7919) ** 4 % 10 ** 15, i % 3 + 1) for k in "ab" for i in range(300)]
    cells = spark.createDataFrame(data, "k string, _unit long, _n long")
    found = order_stats.running_totals(cells, ["k"], "_unit", "_n").collect()
    for k in "ab":
        ahead = 0
        for _, unit, n in sorted(d for d in data if d[0] == k):
            row, = [r for r in found if r.k == k and r._unit == unit]
            assert (row._before, row._total) == (ahead, 600)
            ahead += n
    empty = order_stats.running_totals(cells.limit(0), ["k"], "_unit", "_n")
    assert empty.isEmpty()


def test_numbers_within_keys_of_any_size(spark):
    data = [(i, g, c) for i, g, c in skewed(6)]
    data += [(10 ** 6 + i, "third", 7 * i % 1000) for i in range(len(data) // 2)]
    df = frame(spark, data)
    order = [F.col("c").desc(), F.col("id")]
    found = number_within(Workspace(spark, "test-within"), df, "slices", "g", order, "n")
    groups = {}
    for i, g, c in data:
        groups.setdefault(g, []).append((-c, i))
    expected = [(i, n) for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)]
    assert sorted(rows(found.select("id", "n"))) == sorted(expected)
    parted = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in found.inputFiles()})
    largest = parted.groupBy("g", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < max(map(len, groups.values()))  # no window holds a whole hot key


def test_first_copy_is_kept_by_source_order(spark):
    df = spark.createDataFrame(
        [("a", 5, "late"), ("a", 1, "early"), (None, 2, "x"), (None, 3, "y"), ("b", 4, "only")],
        "k string, _ordinal long, note string")
    assert sorted(r.note for r in keep_first(df, ["k"]).collect()) == ["early", "only", "x"]
    flagged = flag_later_copies(df, ["k"])
    assert sorted(r.note for r in flagged.filter("_later_copy").collect()) == ["late", "y"]


def test_histogram_keeps_empty_bins(spark):
    df = frame(spark, [(i, "x", c) for i, c in enumerate([0, 1, 50, 100])])
    found = histogram(df, "v", 2, bins=4).orderBy("bin").collect()
    assert [r.rows for r in found] == [2, 0, 1, 1]


def test_profile_and_missing(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "a int, b string")
    found = {r.field: (r.rows, round(r.null_rate, 3), r.distinct_values, r.example)
             for r in field_profile(df, "t").collect()}
    assert found == {"a": (3, 0.0, 2, "1"), "b": (3, 0.667, 1, "x")}
    close = {r.field: r.distinct_values for r in field_profile(df, "t", True).collect()}
    assert close == {"a": 2, "b": 1}
    assert [(f, float(p)) for f, p in rows(missing_shares(df))] == [("b", 66.67)]


def test_correlation_matrix_is_symmetric(spark):
    df = spark.createDataFrame([(1, 2.0, True), (2, 4.0, False), (3, 6.0, True)],
                               "a int, b double, c boolean")
    found = {(r.field, r.other): r.correlation
             for r in correlations(df, ["a", "b", "c"]).collect()}
    assert len(found) == 9 and found["a", "b"] == pytest.approx(1.0)
    assert found["a", "c"] == found["c", "a"] == pytest.approx(0.0)


def test_released_stages_are_gone(spark):
    workspace = Workspace(spark, "test-release")
    stored = workspace.stage(spark.range(3), "rows")
    assert stored.count() == 3
    workspace.release()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{workspace.root}/rows")
