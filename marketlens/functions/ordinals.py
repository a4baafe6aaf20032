"""One typed key for the source orders of different tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, NumericType, StringType, StructType, TimestampType,
)

NUMBER = "decimal(38,6)"


def _parts(column: Column, kind: DataType) -> list[Column]:
    if isinstance(kind, StructType):
        return [part for field in kind.fields
                for part in _parts(column.getField(field.name), field.dataType)]
    if isinstance(kind, StringType):
        return [F.struct(F.lit(None).cast(NUMBER).alias("number"), column.alias("text"))]
    if isinstance(kind, DateType):
        column = F.unix_date(column)
    elif isinstance(kind, TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, BooleanType):
        column = column.cast("int")
    elif not isinstance(kind, NumericType):
        raise TypeError(f"a source order cannot hold {kind.simpleString()}")
    return [F.struct(column.cast(NUMBER).alias("number"),
                     F.lit(None).cast("string").alias("text"))]


def source_key(df: DataFrame, ordinal: str = "_ordinal") -> Column:
    """The ordinal as an array of (number, text), which sorts as the ordinal does.

    Ordinals are whatever tells the rows of a source apart: a number, or a struct of file, block and
    row. Numbers compare as numbers and never as text; NULL comes first, as in the ordinal.
    """
    return F.array(*_parts(F.col(ordinal), df.schema[ordinal].dataType))
