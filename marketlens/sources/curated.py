"""Writers and readers for the curated tables, the evidence and the database load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.numbers import to_day, to_number
from marketlens.functions.text import to_flag
from marketlens.plans.quality import stamp_loaded
from marketlens.schema import CURATED_SCHEMAS, LOAD_ORDER, curated_schema

Tables = dict[str, DataFrame]


def typed(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns of a table with their declared types."""
    casts = {"date": to_day, "boolean": to_flag}
    columns = []
    for field in curated_schema(table).fields:
        kind, column = field.dataType.simpleString(), F.col(field.name)
        if dict(df.dtypes)[field.name] == "string" and kind in casts:
            column = casts[kind](column)
        elif dict(df.dtypes)[field.name] == "string" and kind != "string":
            column = (column.try_cast(kind) if kind == "timestamp"
                      else to_number(column, "decimal(38,10)").cast(kind))
        else:
            column = column.cast(kind)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def write_tables(tables: Tables, folder: str, kind: str = "parquet",
                 partition_by: dict[str, list[str]] | None = None) -> None:
    """Write the tables parents first, replacing what is there.

    A table is never seen half written, but a run that fails leaves old and new tables side by side;
    `publish` makes all of them visible at once.
    """
    for name in [n for n in LOAD_ORDER if n in tables]:
        writer = typed(tables[name], name).write.mode("overwrite").format(kind)
        if kind == "csv":
            writer = writer.option("header", True).option("escape", '"')
        keys = (partition_by or {}).get(name)
        (writer.partitionBy(*keys) if keys else writer).save(f"{folder}/{name}")


def read_tables(spark: SparkSession, folder: str, kind: str = "parquet",
                names: list[str] | None = None) -> Tables:
    """Read curated tables with their declared schemas; CSV text is parsed by those types."""
    tables = {}
    for name in names or LOAD_ORDER:
        path = f"{folder}/{name}"
        try:
            if kind == "csv":
                raw = spark.read.option("header", True).option("escape", '"').csv(path)
                tables[name] = typed(raw, name)
            else:
                tables[name] = spark.read.schema(CURATED_SCHEMAS[name]).format(kind).load(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(
                    f"missing curated table {path}; run the cleaning pipeline first") from error
            raise
    return tables


def publish(tables: Tables, folder: str, version: str) -> None:
    """Full refresh of all tables as one step.

    Tables go to a folder of their own; the marker that makes the version visible is written
    last, so a reader sees all tables of a run or none. A version that is visible is never written
    again.
    """
    spark = next(iter(tables.values())).sparkSession
    if version in {row.version for row in _published(spark, folder)}:
        raise ValueError(f"version {version} is already published")
    loaded = {**tables, "pipeline_run_summary": stamp_loaded(tables["pipeline_run_summary"])}
    write_tables(loaded, f"{folder}/versions/{version}")
    spark.range(1).select(F.lit(version).alias("version"),
                          F.current_timestamp().alias("published_at")).write.mode("append").parquet(
        f"{folder}/published")


def _published(spark: SparkSession, folder: str) -> list:
    """The visible versions in order of publication, one small row per refresh."""
    try:
        return spark.read.schema("version string, published_at timestamp").parquet(
            f"{folder}/published").orderBy("published_at").collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


def read_published(spark: SparkSession, folder: str) -> Tables:
    """The version that was published last."""
    found = _published(spark, folder)
    if not found:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return read_tables(spark, f"{folder}/versions/{found[-1].version}")


def save_tables(spark: SparkSession, tables: Tables, database: str,
                bucket_by: dict[str, tuple[int, str]] | None = None) -> None:
    """Save catalogue tables in a namespace of their own.

    Bucketing both facts on inquiry_id lets later joins of the facts skip the shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in [n for n in LOAD_ORDER if n in tables]:
        writer = typed(tables[name], name).write.mode("overwrite").format("parquet")
        if name in (bucket_by or {}):
            buckets, key = bucket_by[name]
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{name}")


def create_table_sql(database: str, table: str) -> str:
    return (f"CREATE TABLE IF NOT EXISTS {database}.{table} "
            f"({CURATED_SCHEMAS[table]}) USING parquet")


def with_json_payload(quarantine: DataFrame) -> DataFrame:
    """The quarantined row as a VARIANT instead of JSON text."""
    return quarantine.withColumn("record_payload", F.parse_json("record_payload"))


def load_jdbc(tables: Tables, url: str, schema: str, properties: dict[str, str],
              batch_rows: int = 5_000, connections: int = 16) -> None:
    """Replace the contents of existing database tables, parents first.

    Truncating keeps keys and indexes of the target; few writers keep the database responsive.
    """
    loaded = {**tables, "pipeline_run_summary": stamp_loaded(tables["pipeline_run_summary"])}
    options = {**properties, "truncate": "true", "cascadeTruncate": "true",
               "batchsize": str(batch_rows), "numPartitions": str(connections)}
    for name in LOAD_ORDER:
        typed(loaded[name], name).write.jdbc(
            url, f"{schema}.{name}", mode="overwrite", properties=options)


def read_jdbc(spark: SparkSession, url: str, schema: str,
              properties: dict[str, str]) -> Tables:
    return {name: typed(spark.read.jdbc(url, f"{schema}.{name}", properties=properties), name)
            for name in LOAD_ORDER}


def write_evidence(evidence: Tables, folder: str) -> None:
    """Every evidence table as JSON lines, dates as ISO text, and the KPIs also as CSV."""
    for name, df in evidence.items():
        df.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(f"{folder}/{name}")
    evidence["kpis"].write.mode("overwrite").option("header", True).csv(
        f"{folder}/analysis_kpis")
