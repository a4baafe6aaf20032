"""Readers for raw CSV extracts and the small reference lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlens.functions.text import null_tokens, require_columns, snake_case
from marketlens.schema import RAW_COLUMNS


def _csv(spark: SparkSession, path: str, multi_line: bool = True,
         malformed: str | None = None) -> DataFrame:
    """All columns as text; values are parsed by rules later, never inferred.

    `malformed` names a column for the text of records whose fields do not fit the header.
    """
    reader = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", multi_line)
    try:
        df = reader.csv(path)
        if malformed is None:
            return df
        # Fields are counted on whole records, so the parser may not skip columns.
        schema = StructType([*df.schema.fields, StructField(malformed, StringType())])
        return (reader.option("columnNameOfCorruptRecord", malformed)
                .option("columnPruning", False).schema(schema).csv(path))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"missing input {path}") from error
        raise


def read_raw_table(spark: SparkSession, path: str, table: str,
                   multi_line: bool = True) -> DataFrame:
    """One raw table with normalised names, NULL spellings resolved and its source order.

    The order is (file, block, running number): the number alone only orders rows of a split.
    `_malformed` is the text of a record with too few or too many fields, else NULL. Quoted fields may
    hold line breaks, which all read as a line feed, so one task reads a file; extracts without such fields may be read in splits
    (`multi_line=False`).
    """
    df = _csv(spark, path, multi_line, "_malformed")
    names = {name: snake_case(name) for name in df.columns if name != "_malformed"}
    df = df.select(
        *[null_tokens(f"`{name}`").alias(target) for name, target in names.items()],
        F.struct(F.col("_metadata.file_name").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_ordinal"),
        "_malformed")
    require_columns(df, RAW_COLUMNS[table], table)
    return df.select(*RAW_COLUMNS[table], "_ordinal", "_malformed")


def read_raw(spark: SparkSession, folder: str,
             row_counts: dict[str, Observation] | None = None,
             multi_line: bool = True) -> dict[str, DataFrame]:
    """The six raw tables of a folder of CSV files or CSV directories.

    With `row_counts`, every table gets an Observation there that reports its rows once the
    table has been read by an action. The action must scan the table once: a range sort samples
    its input first and would count the rows twice.
    """
    tables = {}
    for table in RAW_COLUMNS:
        df = read_raw_table(spark, f"{folder}/{table}.csv", table, multi_line)
        if row_counts is not None:
            row_counts[table] = Observation(f"rows_{table}")
            df = df.observe(row_counts[table], F.count(F.lit(1)).alias("rows"))
        tables[table] = df
    return tables


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Vehicle catalogue; its distinct brands are the approved brand spellings."""
    return _csv(spark, path).select("brand", "model", "vehicle_type")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Canton to dealer-region list."""
    return _csv(spark, path).select("canton", "dealer_region")


def with_region(customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Attach the region of each customer's canton; unknown cantons stay NULL."""
    return customers.join(regions.withColumnRenamed("dealer_region", "customer_region"),
                          "canton", "left")
