"""Calendar attributes and date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_of(day: str | Column) -> Column:
    return F.trunc(day, "MM")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def calendar_columns(day: str = "date") -> list[Column]:
    return [
        F.col(day).alias("date"),
        F.year(day).cast("smallint").alias("year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def date_spine(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """Every day from 1 January of the lowest to 31 December of the highest year."""
    return bounds.select(F.explode(F.sequence(
        F.make_date(F.year(low), F.lit(1), F.lit(1)),
        F.make_date(F.year(high), F.lit(12), F.lit(31)))).alias("date"))


def label_spine(spark: SparkSession, name: str, labels: list[str]) -> DataFrame:
    """The fixed labels of a band with their order."""
    words = F.array(*[F.lit(label) for label in labels])
    return spark.range(1).select(F.posexplode(words).alias("_order", name))
