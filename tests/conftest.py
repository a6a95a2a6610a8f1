import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("quarry-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return TESTDATA


@pytest.fixture()
def tiny_broadcast(spark, monkeypatch):
    """Force the shuffled plans: nothing counts as small, blocks hold few rows."""
    from quarry.operators import pairs

    spark.conf.set("quarry.broadcast.bytes", "2000")
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 40)
    yield
    spark.conf.unset("quarry.broadcast.bytes")
