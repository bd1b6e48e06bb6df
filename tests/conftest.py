import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("saltkv-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests run in local mode: a private folder stands in for the shared one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="saltkv-test-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from saltkv.session import scratch_path

    def make(name="t"):
        return local_path(scratch_path(spark, name))

    return make


def local_path(uri: str) -> str:
    """Local file-system path of a ``file:`` URI (tests write files directly)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri
