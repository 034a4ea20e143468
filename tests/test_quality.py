from __future__ import annotations

import pytest

import tabclean as tc

DIRTY = [("a", 1, [1]), ("  ", 2, None), (None, None, [2]), ("a", 1, [1])]
SCHEMA = "s string, n int, arr array<int>"


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(DIRTY, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_missing(dirty, rows):
    assert rows(tc.row_count(dirty)) == [(4,)]
    assert rows(tc.null_counts(dirty)) == [(1, 1, 1)]
    assert rows(tc.missing_counts(dirty)) == [(2, 1, 1)]
    assert rows(tc.missing_ratios(dirty)) == [(0.5, 0.25, 0.25)]


def test_empty_table(empty, rows):
    assert rows(tc.null_counts(empty)) == [(0, 0, 0)]
    assert rows(tc.missing_counts(empty)) == [(0, 0, 0)]
    assert rows(tc.missing_ratios(empty)) == [(None, None, None)]
    assert rows(tc.cardinality_ratios(empty, ["s", "n"])) == [(None, None)]
    assert rows(tc.distinct_counts(empty, ["s"])) == [(0,)]
    assert rows(tc.describe_columns(empty, ["n"])) == [("n", 0, None, None, None, None)]


def test_distinct(dirty, rows):
    assert rows(tc.distinct_values(dirty, "s")) == [(None,), ("  ",), ("a",)]
    assert rows(tc.distinct_counts(dirty, ["s", "n"])) == [(2, 2)]
    assert rows(tc.distinct_counts(dirty, ["s", "n"], approx=True)) == [(2, 2)]
    assert rows(tc.cardinality_ratios(dirty, ["s", "n"])) == [(0.5, 0.5)]
    one = tc.cardinality_ratio(dirty, "s")
    assert one.columns == ["cardinality_ratio"] and rows(one) == [(0.5,)]


def test_value_counts(dirty, rows):
    assert rows(tc.value_counts(dirty, ["s", "n"])) == [
        ("n", None, 1), ("n", "1", 2), ("n", "2", 1), ("s", None, 1), ("s", "  ", 1), ("s", "a", 2),
    ]
    with pytest.raises(TypeError):
        tc.value_counts(dirty, ["arr"])


def test_value_counts_weighted(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 2), (None, 4)], "s string, w bigint")
    assert rows(tc.value_counts(df, ["s"], weight="w")) == [("s", None, 4), ("s", "a", 5)]


def test_describe(dirty, rows):
    ((name, count, mean, sd, low, high),) = rows(tc.describe_columns(dirty, ["n"]))
    assert (name, count, low, high) == ("n", 3, 1, 2)
    assert mean == pytest.approx(4 / 3) and sd == pytest.approx(0.57735, abs=1e-5)
    with pytest.raises(TypeError):
        tc.describe_columns(dirty, ["s"])


def test_text_length(dirty, rows):
    ((name, count, mean, _, low, high),) = rows(tc.text_length_stats(dirty, "s"))
    assert (name, count, low, high) == ("s_length", 3, 1, 2) and mean == pytest.approx(4 / 3)


def test_frequency(dirty, rows):
    assert rows(tc.frequency(dirty, "n")) == [(None, 1), (1, 2), (2, 1)]


def test_domain(spark, rows):
    ints = spark.createDataFrame([(0,), (1,), (2,), (None,)], "f int")
    assert rows(tc.domain_violations(ints, "f", (0, 1))) == [(2,)]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert rows(tc.domain_violations(flags, "f", (0, 1))) == []
    text = spark.createDataFrame([("0",), ("1",), ("3",), ("x",), (None,)], "f string")
    assert rows(tc.domain_violations(text, "f", (0, 1))) == [("3",), ("x",)]
    assert rows(tc.domain_violations(text, "f", ("0", "1", "3"))) == [("x",)]


def test_non_positive(spark, rows):
    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,), (None,), (float("nan"),)], "x double")
    assert rows(tc.non_positive(df, "x")) == [(-1.0,), (0.0,)]


def test_preview_and_samples(spark, rows):
    df = spark.range(100).selectExpr("id", "-id AS neg")
    assert rows(tc.preview(df, 2, order_by="neg")) == [(98, -98), (99, -99)]
    assert tc.preview(df).count() == 5
    assert rows(tc.sample_values(df, ["neg"], 2, order_by=["id"])) == [(-1,), (0,)]


def test_scans_read_only_what_they_need(spark, plan):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(tc.frequency(orders, "o_orderstatus"))
    assert "ReadSchema: struct<o_orderstatus:string>" in text
    text = plan(tc.non_positive(orders.select("o_totalprice"), "o_totalprice"))
    assert "LessThanOrEqual(o_totalprice,0.0)" in text


def test_profiles_need_one_scan_and_no_row_shuffle(spark, plan):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(tc.missing_ratios(orders), run=False)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "Exchange SinglePartition" in text
    text = plan(tc.value_counts(orders, ["o_orderstatus", "o_orderpriority"]), run=False)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_count" in text


def test_dots_in_column_names(spark, rows):
    """Names are taken literally; a dot does not reach into a struct."""
    t, n = "blood.type", "b.p."
    df = spark.createDataFrame([(" A ", 1), ("", 2), (" A ", 1)], [t, n])
    assert rows(tc.missing_counts(df)) == [(1, 0)] and rows(tc.null_counts(df)) == [(0, 0)]
    assert rows(tc.standardize_text(df, [t]).select(f"`{t}`")) == [("",), ("a",), ("a",)]
    assert rows(tc.blank_to_null(df, [t])) == [(None, 2), (" A ", 1), (" A ", 1)]
    assert rows(tc.duplicate_report(df)) == [(3, 2, 1)]
    assert rows(tc.distinct_values(df, t)) == [("",), (" A ",)]
    assert rows(tc.distinct_counts(df, [t, n])) == [(2, 2)]
    assert rows(tc.value_counts(df, [t])) == [(t, "", 1), (t, " A ", 2)]
    assert rows(tc.describe_columns(df, [n]))[0][:2] == (n, 3)
    assert rows(tc.text_length_stats(df, t))[0][:2] == (f"{t}_length", 3)
    assert rows(tc.frequency(df, n)) == [(1, 2), (2, 1)]
    assert rows(tc.domain_violations(df, n, (1,))) == [("", 2)]
    assert rows(tc.non_positive(df, n)) == []
    assert rows(tc.sample_values(df, [n], 1, order_by=f"`{n}`")) == [(1,)]
    for rel_err in (0, 0.01):
        assert rows(tc.quantile_bounds(df, [n], rel_err=rel_err))[0][:3] == (n, 1.0, 2.0)
        assert rows(tc.iqr_outliers(df, n, rel_err=rel_err)) == []
        assert rows(tc.null_outliers(df, [n], rel_err=rel_err)) == rows(df)
