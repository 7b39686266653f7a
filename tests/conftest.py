from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablesync-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tablesync.session import Scratch

    made = Scratch(spark)
    yield made
    made.clear()


@pytest.fixture
def new_target(spark, tmp_path):
    from tablesync.sources.snapshot import SnapshotTarget

    def make(name="t", buckets=4):
        return SnapshotTarget(spark, str(tmp_path / name), buckets=buckets)

    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
