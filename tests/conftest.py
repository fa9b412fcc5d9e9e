from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder below the session's shared one."""
    from millrace.storage import work_folder

    return work_folder(spark, "test")


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
