"""Session settings and the shared work folder used between pipeline stages."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot inquiry or dealer must be split even when that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Stages are packed to a tenth and shuffled keys to a few bytes a row, so a task of Spark's default
# size holds millions of them, and its hash maps and sorts spill. A size set by the user stays.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan in this package is written for."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: spark.checkpoint.dir, or a temp folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="marketlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Stages are written once and read a few times, so they are packed harder than Spark's default.
STAGE_OPTIONS = {"compression": "zstd"}


# Rows a bucket holds on average, so that no task grows with its table.
BUCKET_ROWS = 400_000


def buckets_for(df: DataFrame) -> int:
    """Buckets for the rows of a stored table; counting them reads its file footers only."""
    smallest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(smallest, -(-df.count() // BUCKET_ROWS))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application stored in the shared folder."""
    _delete(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")


def cut(df: DataFrame) -> DataFrame:
    """Store an intermediate result that several branches read and read it back.

    The source is then computed once, survives lost executors, and joins see its real size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/cut-{uuid.uuid4().hex}"
    df.write.options(**STAGE_OPTIONS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Materialises stage tables as Parquet, so a lost executor never replays the whole job."""

    def __init__(self, spark: SparkSession, label: str):
        digest = hashlib.sha1(label.encode()).hexdigest()[:12]
        self.spark = spark
        # A folder of its own per workspace: stored stages are read lazily and must not change.
        run = uuid.uuid4().hex[:8]
        self.root = (f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
                     f"/{digest}-{run}")
        self.bucketed: list[str] = []

    def stage(self, df: DataFrame, name: str, key: str | None = None,
              buckets: int | None = None, placed: bool = False) -> DataFrame:
        """The stored rows; with a key they are bucketed by it, and later joins, windows and
        groups on that key need no shuffle.

        Rows that the plan has by the key already are not moved. `placed` says so of a union of
        such rows, which the optimizer does not see; else a task would write to many buckets.
        """
        path = f"{self.root}/{name}"
        if key is not None and not placed:
            df = df.repartition(buckets, key)
        writer = df.write.mode("overwrite").options(**STAGE_OPTIONS)
        if key is None:
            writer.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)
        table = f"stage_{uuid.uuid4().hex}"
        self.bucketed.append(table)
        writer.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(table)
        return self.spark.table(table)

    def stage_all(self, frames: dict[str, DataFrame],
                  bucketed: dict[str, tuple] | None = None) -> dict[str, DataFrame]:
        """Write independent stages side by side, so small ones do not wait for large ones.

        `bucketed` has the key, buckets and placing of stages that `stage` is to bucket.
        """
        bucketed = bucketed or {}
        with ThreadPoolExecutor(len(frames)) as pool:
            stored = pool.map(lambda item: self.stage(item[1], item[0], *bucketed.get(item[0], ())),
                              frames.items())
            return dict(zip(frames, stored))

    def release(self) -> None:
        """Delete the stored stages once their results have been written elsewhere."""
        for table in self.bucketed:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(self.spark, self.root)
