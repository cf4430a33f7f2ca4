from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeferry.plans.workspace import Workspace, close_all  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lakeferry-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    close_all()
    session.stop()


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
