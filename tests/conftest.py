import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import release  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    release(session)
    session.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]


def column(df, name):
    return [r[name] for r in df.collect()]
