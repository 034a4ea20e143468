from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tabclean-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, nulls first."""

    def key(value):
        return (value is not None, str(type(value)), value if value is not None else 0)

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [key(v) for v in t])

    return collect


@pytest.fixture
def plan():
    """The physical plan of a frame as text, after running it so that it is final."""

    def text(df, run=True):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
