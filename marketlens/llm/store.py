"""Tables of the data folder, and intermediates in the folder all executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from marketlens.session import _delete, shared_folder

# Shuffle files of a finished write are not needed again; free their disk at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where its folder is visible to them.

    Elsewhere the package is installed or sent with --py-files, as usual. Arrow batches are kept
    small, so that the texts of one fit in a worker many times over.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    for way in ("Reader", "Writer"):  # ORC batches hold the arrays of whole documents
        spark.conf.set(f"spark.sql.orc.columnar{way}BatchSize", "256")
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the folder all executors share."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate as Parquet to spark.checkpoint.dir and read it back.

    It is then computed once, and a lost executor repeats only the tasks that read it.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    with with_settings(spark, {_CLEANUP: "true"}):
        # Not the default codec, whose buffers outside the heap wait for a full collection.
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a stored intermediate that nothing will read again."""
    for path in {os.path.dirname(name) for name in df.inputFiles()}:
        if "/llm-" in path:
            _delete(df.sparkSession, path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
