"""Table and field profiles."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.dedupe import duplicate_count
from marketlens.operators.joins import one_row
from marketlens.operators.order_stats import units


def field_profile(df: DataFrame, table: str, approximate: bool = False) -> DataFrame:
    """Type, rows, missing share, distinct values and smallest value of every column."""
    fields = F.explode(F.array(*[
        F.struct(F.lit(field.name).alias("field"), F.lit(field.dataType.simpleString())
                 .alias("data_type"), F.col(field.name).cast("string").alias("value"))
        for field in df.schema.fields]))
    cells = df.select(fields.alias("f")).select("f.*")
    if approximate:
        found = cells.groupBy("field", "data_type").agg(
            F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) - F.count("value")).alias("missing"),
            F.approx_count_distinct("value").alias("distinct_values"),
            F.min("value").alias("example"))
    else:
        # One cell per distinct value first: copies combine before the shuffle.
        found = (cells.groupBy("field", "data_type", "value").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("field", "data_type").agg(
                     F.sum("n").alias("rows"),
                     F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
                     .alias("missing"),
                     F.count("value").alias("distinct_values"),
                     F.min("value").alias("example")))
    return found.select(
        F.lit(table).alias("table_name"), "field", "data_type", "rows",
        (F.col("missing") / F.col("rows")).alias("null_rate"), "distinct_values", "example")


def missing_shares(df: DataFrame) -> DataFrame:
    """Percentage of missing values of the columns that have any."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count(F.when(F.col(name).isNull(), 1)).alias(name) for name in df.columns])
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).alias("missing"))
        for name in df.columns]))
    return (wide.select("_rows", entries.alias("e")).select(
        "e.field",
        F.round(F.try_divide(F.col("e.missing").cast("decimal(20,0)") * 100,
                             F.col("_rows").cast("decimal(20,0)")), 2).alias("missing_pct"))
        .filter("missing_pct > 0"))


def table_overview(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and duplicate keys per table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                    duplicate_count(key).alias("duplicate_keys"))
             for name, (df, key) in tables.items()]
    overview = parts[0]
    for part in parts[1:]:
        overview = overview.unionByName(part)
    return overview


def histogram(df: DataFrame, value: str, scale: int, bins: int = 45) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; empty bins are kept."""
    cells = df.filter(F.col(value).isNotNull()).select(units(value, scale).alias("_u"))
    bounds = cells.agg(F.min("_u").alias("_lo"), F.max("_u").alias("_hi"))
    span = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1))
    counts = (one_row(cells, bounds)
              .withColumn("_span", span)
              .groupBy(F.least(F.expr(f"((_u - _lo) * {bins}) div _span"), F.lit(bins - 1))
                       .cast("bigint").alias("bin"))
              .agg(F.count(F.lit(1)).alias("rows")))
    spine = one_row(df.sparkSession.range(bins).withColumnRenamed("id", "bin"), bounds)
    edge = F.col("_lo") + span * F.col("bin") / bins
    return (spine.join(counts, "bin", "left").select(
        "bin", (edge / 10 ** scale).alias("lower_edge"),
        F.coalesce("rows", F.lit(0)).alias("rows")))


def correlations(df: DataFrame, fields: list[str]) -> DataFrame:
    """Pearson correlation of every pair, both ways, from one pass over the rows."""
    numeric = df.select(*[F.col(name).cast("int").cast("double").alias(name)
                          if dict(df.dtypes)[name] == "boolean"
                          else F.col(name).cast("double").alias(name) for name in fields])
    pairs = list(combinations_with_replacement(fields, 2))
    wide = numeric.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for first, second in dict.fromkeys([(a, b), (b, a)]):
            entries.append(F.struct(F.lit(first).alias("field"), F.lit(second).alias("other"),
                                    F.col(f"p{i}").alias("correlation")))
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
