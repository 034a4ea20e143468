"""Every registered query against DuckDB on the supplied tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import oracles, queries

SF = "/root/testdata/sf0.001"
QUERIES = queries.all_queries()
ORACLES = oracles.all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return connection


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else v
    return [columns[i] for i in order], sorted(repr([cell(r[i]) for i in order]) for r in data)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    assert found == canonical([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_custkey", "seg", "bal", "flag"] and df.count() == 150
