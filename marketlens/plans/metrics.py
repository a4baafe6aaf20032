"""Named measures over the two facts, by any dimensions and filters, without mixing grains.

Each measure has one home fact and is kept as mergeable states. A fact first shrinks to states at the
grain of its foreign keys; these meet the dimensions one by one and merge after each, so a skewed
dealer or vehicle is summed before it is shuffled. Results of several facts are stacked and
collapsed on the group keys, so no join can multiply rows. Dealer filters reach
quotes only; date, customer, vehicle and inquiry filters reach inquiries and their quotes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.functions import text as T
from marketlens.functions.bands import band_below, band_order
from marketlens.functions.calendar import month_of
from marketlens.operators import states as S
from marketlens.operators.joins import join_null_safe
from marketlens.operators.order_stats import cell_percentiles, units, value_ranks
from marketlens.plans.views import Tables
from marketlens.schema import (
    ISSUE_CATEGORIES, METRIC_LABELS, REPORT_RESPONSE_BANDS, SLA_HOURS, STAGE_LABELS,
)
from marketlens.session import cut

CUSTOMER = ["customer_type", "age_group", "canton", "preferred_contact_method"]
VEHICLE = ["brand", "model", "vehicle_type", "fuel_type", "vehicle_condition",
           "mileage_bracket", "market_value_band"]
DEALER = ["dealer_id", "dealer_name", "dealer_region", "dealer_type", "dealer_rating",
          "active_flag"]
DEALERS = ["dealer_id", "dealer_name"]
DATE = ["date", "month_start", "year"]
INQUIRY = ["lead_source", "status", "response_band", "response_band_order"]
REACH = {
    "inquiry": [*DATE, *CUSTOMER, *VEHICLE, *INQUIRY],
    "quote": [*DATE, *CUSTOMER, *VEHICLE, *INQUIRY, *DEALER],
    "quote_date": [*DATE, *CUSTOMER, *VEHICLE, *INQUIRY, *DEALER],
    "dealer": DEALER,
    "quality": ["metric_name", "metric_label", "stage"],
    "issue": ["table_name", "issue_type", "issue_category"],
    "run": ["table_name", "pipeline_stage", "load_status"],
}


@dataclass(frozen=True)
class Base:
    """An aggregate of one fact. `without` lists dimensions whose context is removed."""

    fact: str
    measure: S.Measure
    without: tuple[str, ...] = ()


@dataclass(frozen=True)
class Derived:
    """A value computed after aggregation from other measures."""

    inputs: tuple[str, ...]
    value: Callable[..., Column]


@dataclass(frozen=True)
class Special:
    """A measure that needs its own pass: a percentile, a rank or a shifted calendar."""

    kind: str
    inputs: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)


def _divide(*inputs: str) -> Derived:
    return Derived(inputs, N.quotient)


def _fixed_rate(metric: str, stage: str = "Processed") -> Base:
    def value() -> Column:
        chosen = (F.col("stage") == stage) & (F.col("metric_name") == metric)
        return F.when(chosen, F.col("rate"))
    return Base("quality", S.greatest(value), ("stage", "metric_name"))


def _stage_rate(stage: str) -> Base:
    return Base("quality", S.greatest(lambda: F.when(F.col("stage") == stage, F.col("rate"))),
                ("stage",))


def _sold() -> Column:
    return F.col("conversion_flag")


def _won() -> Column:
    return F.col("accepted_flag")


def _accepted_value() -> Column:
    return F.when(_won(), F.col("quote_amount"))


def _growth(now: Column, before: Column) -> Column:
    return N.quotient(now - before, before)


# The primary keys are unique by load check, so a distinct count of them is a row count.
MEASURES: dict[str, Base | Derived | Special] = {
    "total_inquiries": Base("inquiry", S.rows()),
    "total_quotes": Base("quote", S.rows()),
    "total_quotes_by_quote_date": Base("quote_date", S.rows()),
    "converted_inquiries": Base("inquiry", S.count_where(_sold)),
    "conversion_rate": _divide("converted_inquiries", "total_inquiries"),
    "average_quotes_per_inquiry": _divide("total_quotes", "total_inquiries"),
    "average_days_to_conversion": Base("inquiry", S.mean("days_to_conversion", _sold)),
    "inquiries_under_sla":
        Base("inquiry", S.count_where(lambda: F.col("fastest_response_hours") < SLA_HOURS)),
    "sla_compliance_rate": _divide("inquiries_under_sla", "total_inquiries"),
    "average_quote": Base("quote", S.mean("quote_amount")),
    "maximum_quote": Base("quote", S.greatest(lambda: F.col("quote_amount"))),
    "minimum_quote": Base("quote", S.least("quote_amount")),
    "median_quote": Special("median", options={"fact": "quote", "column": "quote_amount",
                                               "scale": 2}),
    "average_highest_quote": Base("inquiry", S.mean("highest_quote")),
    "average_lowest_quote": Base("inquiry", S.mean("lowest_quote")),
    "average_quote_spread": Base("inquiry", S.mean("quote_spread")),
    "average_quote_spread_pct": Base("inquiry", S.mean("quote_spread_pct")),
    "average_sale_value": Base("inquiry", S.mean("final_sale_price", _sold)),
    "total_accepted_quote_value": Base("quote", S.total(_accepted_value)),
    "quote_to_market_ratio":
        Base("quote", S.quotient_of_totals("quote_amount", "estimated_market_value")),
    "average_estimated_market_value": Base("quote", S.mean("estimated_market_value")),
    "quote_anomalies": Base("quote", S.count_where(lambda: F.col("anomaly_flag"))),
    "quote_anomaly_rate": _divide("quote_anomalies", "total_quotes"),
    "average_response_time": Base("quote", S.mean("response_time_hours")),
    "average_fastest_response_time": Base("inquiry", S.mean("fastest_response_hours")),
    "dealer_wins": Base("quote", S.count_where(_won)),
    "dealer_win_rate": _divide("dealer_wins", "total_quotes"),
    "average_dealer_competitiveness": Base("quote", S.mean("quote_to_market_ratio")),
    "dealer_accepted_value": Base("quote", S.total(_accepted_value)),
    "active_dealers": Base("dealer", S.count_where(lambda: F.col("active_flag"))),
    "dealer_rank": Special("rank", ("dealer_wins", "total_quotes"), {"by": "win_rate"}),
    "dealer_win_rate_top_7": Special(
        "rank", ("dealer_wins", "total_quotes", "dealer_win_rate"),
        {"by": "win_rate", "top": 7, "show": "dealer_win_rate"}),
    "dealer_accepted_value_top_5": Special(
        "rank", ("dealer_accepted_value", "total_quotes"),
        {"by": "accepted_value", "top": 5, "show": "dealer_accepted_value"}),
    "previous_month_inquiries": Special("shift", ("total_inquiries",), {"months": (1,)}),
    "month_over_month_inquiry_growth":
        Derived(("total_inquiries", "previous_month_inquiries"), _growth),
    "previous_year_inquiries": Special("shift", ("total_inquiries",), {"months": (12,)}),
    "year_over_year_inquiry_growth":
        Derived(("total_inquiries", "previous_year_inquiries"), _growth),
    "previous_month_conversion_rate": Special(
        "shift", ("converted_inquiries", "total_inquiries"), {"months": (1,)}),
    "conversion_rate_change": Derived(
        ("conversion_rate", "previous_month_conversion_rate"), lambda now, before: now - before),
    "rolling_3m_conversion_rate": Special(
        "shift", ("converted_inquiries", "total_inquiries"), {"months": (0, 1, 2)}),
    "data_quality_metric_rate": Base("quality", S.greatest(lambda: F.col("rate"))),
    "raw_data_quality_rate": _stage_rate("Raw"),
    "raw_data_quality_score": _fixed_rate("overall_data_quality_score", "Raw"),
    "processed_data_quality_rate": _stage_rate("Processed"),
    "data_quality_improvement": Derived(
        ("processed_data_quality_rate", "raw_data_quality_rate"),
        lambda after, before: (after - before) * 100),
    "data_quality_score": _fixed_rate("overall_data_quality_score"),
    "completeness_rate": _fixed_rate("completeness_rate"),
    "validity_rate": _fixed_rate("validity_rate"),
    "uniqueness_rate": _fixed_rate("uniqueness_rate"),
    "referential_integrity_rate": _fixed_rate("referential_integrity_rate"),
    "affected_rows": Base("issue", S.total(lambda: F.col("affected_rows"))),
    "raw_records": Base("run", S.total(lambda: F.col("raw_records"))),
    "clean_records": Base("run", S.total(lambda: F.col("clean_records"))),
    "rejected_records": Base("run", S.total(lambda: F.col("quarantined_records"))),
    "loaded_records": Base("run", S.total(lambda: F.col("loaded_records"))),
}


def _date_columns(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns({"date": F.col(day), "month_start": month_of(day),
                           "year": F.year(day)})


# Dimensions as (table, key, columns); a dimension not asked for is not joined.
DIMENSIONS = [("dim_customer", "customer_id", CUSTOMER), ("dim_vehicle", "vehicle_id", VEHICLE),
              ("dim_dealer", "dealer_id", [c for c in DEALER if c != "dealer_id"])]


def _inquiry_frame(t: Tables) -> DataFrame:
    hours = F.col("fastest_response_hours")
    return _date_columns(t["fact_inquiry"], "inquiry_date").withColumns({
        "response_band": band_below(hours, REPORT_RESPONSE_BANDS),
        "response_band_order": band_order(hours, REPORT_RESPONSE_BANDS)})


def _quote_frame(t: Tables, needed: set[str], by_quote_date: bool) -> DataFrame:
    """Quotes with the columns and foreign keys of their inquiry that are asked for."""
    df = t["fact_quote"]
    if by_quote_date:
        df = _date_columns(df, "quote_date")
    own = set(DATE) if by_quote_date else set()
    wanted = [c for c in (*DATE, *INQUIRY, "customer_id", "vehicle_id")
              if c in needed and c not in own]
    if wanted:
        df = df.join(_inquiry_frame(t).select("inquiry_id", *wanted), "inquiry_id", "left")
    return df


def _frame(t: Tables, fact: str, needed: set[str]) -> DataFrame:
    if fact == "inquiry":
        return _inquiry_frame(t)
    if fact in ("quote", "quote_date"):
        return _quote_frame(t, needed, fact == "quote_date")
    if fact == "dealer":
        return t["dim_dealer"]
    if fact == "quality":
        return t["data_quality_metrics"].withColumn(
            "metric_label", T.label_of("metric_name", METRIC_LABELS))
    if fact == "issue":
        return t["data_quality_issue_log"].withColumn(
            "issue_category", T.category_of("issue_type", ISSUE_CATEGORIES))
    return t["pipeline_run_summary"].withColumn(
        "pipeline_stage", T.label_of("table_name", STAGE_LABELS))


def _predicate(name: str, wanted) -> Column:
    """A list selects members, a (low, high) tuple a closed range."""
    if isinstance(wanted, tuple):
        return F.col(name).between(*wanted)
    return F.col(name).isin(list(wanted))


def _filtered(df: DataFrame, filters: dict) -> DataFrame:
    for name, wanted in filters.items():
        df = df.filter(_predicate(name, wanted))
    return df


def _folded(t: Tables, fact: str, by: list[str], filters: dict, measures: dict[str, S.Measure],
            without=(), unit: Column | None = None) -> tuple[DataFrame, list[str]]:
    """States of a fact at the group keys that reach it, and these keys.

    unit: a further key `_unit` of the rows where it is not NULL.
    """
    reach = [c for c in REACH[fact] if c not in without]
    keys = [c for c in by if c in reach]
    active = {c: v for c, v in filters.items() if c in reach}
    asked = {*keys, *active}
    dimensions = [(table, key, [c for c in columns if c in asked])
                  for table, key, columns in DIMENSIONS
                  if fact in ("inquiry", "quote", "quote_date") and asked.intersection(columns)]
    foreign = {c for _, _, columns in dimensions for c in columns}
    df = _frame(t, fact, asked | {key for _, key, _ in dimensions})
    df = _filtered(df, {c: v for c, v in active.items() if c not in foreign})
    extra = [] if unit is None else ["_unit"]
    if unit is not None:
        df = df.withColumn("_unit", unit).filter("_unit is not null")
    group = [c for c in keys if c not in foreign]
    group += [key for _, key, _ in dimensions if key not in group]
    states = S.partial(df, [*group, *extra], measures)
    for table, key, columns in dimensions:
        states = states.join(t[table].select(key, *columns), key, "left")
        states = _filtered(states, {c: v for c, v in active.items() if c in columns})
        group = [c for c in group if c != key or key in keys]
        group += [c for c in columns if c in keys]
        states = S.merged(states, [*group, *extra], measures)
    return states.select(*keys, *[c for c in states.columns if c not in keys]), keys


def _stack(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Collapse results with equal keys into one row; NULL keys meet as well."""
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def _aggregate(t: Tables, names: list[str], by: list[str], filters: dict) -> DataFrame:
    """All base and median measures at the group keys."""
    groups: dict[tuple, list[str]] = {}
    for name in names:
        measure = MEASURES[name]
        if isinstance(measure, Base):
            groups.setdefault((measure.fact, measure.without), []).append(name)
    found: dict[tuple, list[DataFrame]] = {}
    for (fact, without), members in groups.items():
        measures = {m: MEASURES[m].measure for m in members}
        states, keys = _folded(t, fact, by, filters, measures, without)
        found.setdefault(tuple(keys), []).append(S.finished(states, keys, measures))
    for name in names:
        measure = MEASURES[name]
        if isinstance(measure, Special) and measure.kind == "median":
            scale, size = measure.options["scale"], {"_n": S.rows()}
            states, keys = _folded(t, measure.options["fact"], by, filters, size,
                                   unit=units(measure.options["column"], scale))
            cells = cut(S.finished(states, [*keys, "_unit"], size))
            found.setdefault(tuple(keys), []).append(
                cell_percentiles(cells, keys, scale, {name: (1, 2)}))
    levels = sorted(((list(keys), _stack(parts, list(keys))) for keys, parts in found.items()),
                    key=lambda level: -len(level[0]))
    keys, result = levels[0]
    for fewer, coarser in levels[1:]:
        if not set(fewer) <= set(keys):
            raise ValueError(f"no measure reaches both {keys} and {fewer}; ask for them apart")
        # A fact the remaining keys do not reach repeats its coarser value on every row.
        result = (join_null_safe(result, coarser, fewer, "left") if fewer
                  else result.crossJoin(F.broadcast(coarser)))
    return result


def _shifts(t: Tables, names: list[str], by: list[str], filters: dict) -> list[DataFrame]:
    """Move each month's totals forward to the months that look back on it.

    The facts are read once for all shifted measures. Any date filter limits the months shown, not
    the months looked back on, and a year among the keys is that of the month shown.
    """
    if "month_start" not in by or "date" in by:
        raise ValueError(f"{names[0]} needs month_start among the group keys, and not date")
    keys = [c for c in by if c != "year"]
    inputs = list(dict.fromkeys(i for n in names for i in MEASURES[n].inputs))
    totals = cut(_aggregate(
        t, inputs, keys, {c: v for c, v in filters.items() if c not in DATE}))
    shown = _date_columns(t["dim_date"], "date")
    for name in DATE:
        if name in filters:
            shown = shown.filter(_predicate(name, filters[name]))
    shown = shown.select("month_start").distinct()
    parts = []
    for name in names:
        measure = MEASURES[name]
        months = F.array(*[F.lit(m) for m in measure.options["months"]])
        moved = totals.withColumn("_shift", F.explode(months)).withColumn(
            "month_start", F.add_months("month_start", F.col("_shift")))
        sums = moved.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measure.inputs])
        if "year" in by:
            sums = sums.withColumn("year", F.year("month_start"))
        value = (F.col(measure.inputs[0]) if len(measure.inputs) == 1
                 else N.quotient(*[F.col(c) for c in measure.inputs]))
        parts.append(sums.join(shown, "month_start", "left_semi").select(*by, value.alias(name)))
    return parts


def _rank(df: DataFrame, name: str, measure: Special, by: list[str],
          min_quotes: int) -> DataFrame:
    """Dense rank among the dealers with enough quotes, under each value of the other keys.

    Dealers without enough quotes get no rank.
    """
    within = [c for c in by if c not in DEALERS]
    enough = F.col("total_quotes") >= min_quotes
    if measure.options["by"] == "win_rate":
        score = N.ratio(F.col("dealer_wins").cast(N.COUNT), F.col("total_quotes"))
        scale = 15
    else:
        score, scale = F.col("dealer_accepted_value"), 2
    unit = (score * F.lit(10 ** scale)).cast("bigint")
    ranked = value_ranks(df.withColumn("_score", F.when(enough, unit)), "_score", "_place",
                         "dense_rank", descending=True, within=within)
    place = F.col("_place")
    if "top" in measure.options:
        value = F.when(place <= measure.options["top"], F.col(measure.options["show"]))
    else:
        value = place
    return ranked.withColumn(name, value).drop("_score", "_place")


def _closure(measures: list[str]) -> list[str]:
    """The measures and everything they are computed from, inputs first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        measure = MEASURES[name]
        shifts = isinstance(measure, Special) and measure.kind == "shift"
        for source in () if shifts else getattr(measure, "inputs", ()):
            visit(source)
        if name not in ordered:
            ordered.append(name)

    for name in measures:
        visit(name)
    return ordered


def _validate(measures: list[str], by: list[str], filters: dict) -> None:
    dimensions = {c for columns in REACH.values() for c in columns}
    unknown = [m for m in measures if m not in MEASURES]
    unknown += [c for c in (*by, *filters) if c not in dimensions]
    if unknown:
        raise ValueError(f"unknown measures or dimensions: {unknown}")
    facts = {getattr(MEASURES[n], "fact", None) or getattr(MEASURES[n], "options", {}).get("fact")
             for n in _closure(measures)} | {
        "inquiry" for n in _closure(measures) if getattr(MEASURES[n], "kind", "") == "shift"}
    ranked = [n for n in measures if getattr(MEASURES[n], "kind", "") == "rank"]
    if ranked and not set(by) & set(DEALERS):
        raise ValueError(f"{ranked[0]} needs a dealer among the group keys")
    reached = {c for fact in facts - {None} for c in REACH[fact]}
    if not set(by) <= reached:
        raise ValueError(f"no measure reaches {sorted(set(by) - reached)}")


def evaluate(t: Tables, measures: list[str], by: list[str] | None = None,
             filters: dict | None = None, min_quotes: int = 250) -> DataFrame:
    """Named measures by the given dimensions under the given filters.

    `filters` maps a dimension to a list of members or a (low, high) range.
    """
    by, filters = list(by or []), dict(filters or {})
    _validate(measures, by, filters)
    needed = _closure(measures)
    direct = [n for n in needed if isinstance(MEASURES[n], Base)
              or getattr(MEASURES[n], "kind", None) == "median"]
    parts = [_aggregate(t, direct, by, filters)] if direct else []
    shifted = [n for n in needed if getattr(MEASURES[n], "kind", None) == "shift"]
    parts += _shifts(t, shifted, by, filters) if shifted else []
    df = _stack(parts, by)
    if any(getattr(MEASURES[n], "kind", None) == "rank" for n in needed):
        df = cut(df)  # each rank reads the aggregated rows twice
    for name in needed:
        measure = MEASURES[name]
        if isinstance(measure, Derived):
            df = df.withColumn(name, measure.value(*[F.col(c) for c in measure.inputs]))
        elif getattr(measure, "kind", None) == "rank":
            df = _rank(df, name, measure, by, min_quotes)
    return df.select(*by, *measures)


# Report queries as (group keys, measures, sort measure or None).
REPORTS: dict[str, tuple[list[str], list[str], str | None]] = {
    "r01": (["month_start"], ["total_inquiries", "converted_inquiries", "conversion_rate"], None),
    "r02": (["lead_source"], ["conversion_rate", "total_inquiries", "converted_inquiries"],
            "conversion_rate"),
    "r03": (["vehicle_type"], ["total_accepted_quote_value", "total_inquiries",
                               "conversion_rate"], "total_accepted_quote_value"),
    "r04": (DEALERS, ["dealer_accepted_value_top_5", "dealer_win_rate", "total_quotes"],
            "dealer_accepted_value_top_5"),
    "r05": (["dealer_region"], ["average_quote", "quote_to_market_ratio"], None),
    "r06": (["vehicle_type"], ["average_quote_spread", "average_quote_spread_pct"], None),
    "r07": (["brand", "vehicle_type"], ["average_estimated_market_value", "average_quote",
                                        "total_quotes", "quote_to_market_ratio"], None),
    "r08": (["vehicle_type", "brand"], ["average_estimated_market_value", "average_quote",
                                        "quote_to_market_ratio", "average_quote_spread",
                                        "average_quote_spread_pct"], None),
    "r09": (["response_band", "response_band_order"], ["conversion_rate", "total_inquiries"],
            None),
    "r10": (["lead_source"], ["conversion_rate", "total_inquiries", "converted_inquiries",
                              "average_sale_value"], None),
    "r11": (["lead_source"], ["total_inquiries", "converted_inquiries", "conversion_rate",
                              "average_fastest_response_time", "average_sale_value"], None),
    "r12": (["mileage_bracket"], ["conversion_rate", "total_inquiries"], None),
    "r13": (DEALERS, ["dealer_win_rate_top_7", "total_quotes", "average_response_time",
                      "dealer_accepted_value"], "dealer_win_rate_top_7"),
    "r14": ([*DEALERS, "dealer_region"], ["average_response_time", "dealer_win_rate",
                                          "total_quotes", "dealer_accepted_value"], None),
    "r15": ([*DEALERS, "dealer_region", "dealer_rating"],
            ["total_quotes", "dealer_win_rate", "average_response_time",
             "average_dealer_competitiveness", "dealer_accepted_value"], None),
    "r16": (DEALERS, ["dealer_accepted_value_top_5", "dealer_win_rate",
                      "average_dealer_competitiveness"], "dealer_accepted_value_top_5"),
    "r17": (["pipeline_stage"], ["raw_records", "clean_records", "rejected_records"], None),
    "r18": (["metric_label"], ["raw_data_quality_rate", "processed_data_quality_rate",
                               "data_quality_improvement"], None),
    "r19": (["pipeline_stage", "load_status"], ["raw_records", "clean_records",
                                                "rejected_records", "loaded_records"], None),
    "r20": (["issue_category"], ["affected_rows"], "affected_rows"),
}


def report(t: Tables, name: str, filters: dict | None = None, min_quotes: int = 250) -> DataFrame:
    """One grouped report query, sorted as the report shows it."""
    by, measures, sort = REPORTS[name]
    df = evaluate(t, measures, by, filters, min_quotes)
    if sort:
        return df.orderBy(F.desc_nulls_last(sort), *by)
    return df.orderBy("response_band_order") if "response_band_order" in by else df.orderBy(*by)
