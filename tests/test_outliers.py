from __future__ import annotations

import math
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tabclean as tc
from tabclean.operators import outliers, quantiles


def by_sorting(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(p * len(kept))) - 1] if kept else None


def frame(spark, values, parts=4):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


def test_bounds(spark, rows):
    df = frame(spark, [100.0, 100.0, 110.0, 120.0, 130.0, 5000.0])
    expected = [("x", 100.0, 130.0, 55.0, 175.0)]
    assert rows(tc.quantile_bounds(df, ["x"], rel_err=0)) == expected
    assert rows(tc.quantile_bounds(df, ["x"])) == expected
    assert tc.fences(df, ["x"])["x"] == (100.0, 130.0, 55.0, 175.0)
    assert tc.fences(df, []) == {}


def test_outliers_are_strictly_outside(spark, rows):
    df = frame(spark, [0.0, 1.0, 2.0, 3.0, 4.0, -3.5, 8.5, 8.0, None])
    low, high = tc.fences(df, ["x"], rel_err=0)["x"][2:]
    inside = df.union(spark.createDataFrame([(low,), (high,)], "x double"))
    kept = {"x": outliers.Fence(0.0, 0.0, low, high)}
    assert low not in [r.x for r in tc.iqr_outliers(inside, "x", limits=kept).collect()]
    assert high not in [r.x for r in tc.iqr_outliers(inside, "x", limits=kept).collect()]


@pytest.mark.parametrize("rel_err", [0, 0.01])
def test_empty_and_all_null_columns(spark, rows, rel_err):
    for values in ([], [None, None]):
        df = frame(spark, values)
        assert rows(tc.quantile_bounds(df, ["x"], rel_err=rel_err)) == [("x", None, None, None, None)]
        assert rows(tc.iqr_outliers(df, "x", rel_err=rel_err)) == []
        assert len(rows(tc.null_outliers(df, ["x"], rel_err=rel_err))) == len(values)


@pytest.mark.parametrize("rel_err", [0, 0.01])
def test_nan_is_a_high_outlier_but_not_in_the_quartiles(spark, rel_err):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, float("nan")])
    assert tc.fences(df, ["x"], rel_err=rel_err)["x"][:2] == (1.0, 3.0)
    (hit,) = tc.iqr_outliers(df, "x", rel_err=rel_err).collect()
    assert math.isnan(hit.x)
    kept = [r.x for r in tc.null_outliers(df, ["x"], rel_err=rel_err).collect()]
    assert sorted(v for v in kept if v is not None) == [1.0, 2.0, 3.0, 4.0] and None in kept


def test_types_and_rows_are_kept(spark):
    df = spark.range(1000).selectExpr(
        "CAST(IF(id = 7, 100000, id % 50) AS INT) AS i", "CAST(id AS DECIMAL(12,2)) AS d", "id AS k"
    )
    out = tc.null_outliers(df, ["i", "d"])
    assert out.dtypes == df.dtypes and out.count() == 1000
    assert [r.k for r in out.filter("i IS NULL").collect()] == [7]


def test_text_columns_are_refused(spark):
    with pytest.raises(TypeError, match="numeric"):
        tc.quantile_bounds(spark.createDataFrame([("a",)], ["t"]), ["t"])
    with pytest.raises(ValueError, match="rel_err"):
        tc.quantile_bounds(spark.range(3), ["id"], rel_err=-1)


def test_every_row_is_outlier_kept_or_null(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) ** 3 for _ in range(3000)] + [None] * 50
    df = frame(spark, values)
    limits = tc.fences(df, ["x"])
    out = tc.iqr_outliers(df, "x", limits=limits).count()
    nulled = tc.null_outliers(df, ["x"], limits=limits)
    assert out > 0
    assert nulled.filter("x IS NULL").count() == out + 50
    assert nulled.count() == 3050


def test_approximate_quartiles_stay_within_the_rank_error(spark):
    n = 40_000
    df = spark.range(n).select((F.hash("id") % 1_000_000).cast("double").alias("x"))
    ordered = sorted(r.x for r in df.collect())
    q1, q3 = tc.fences(df, ["x"], rel_err=0.01)["x"][:2]
    for p, q in ((0.25, q1), (0.75, q3)):
        assert ordered[int((p - 0.011) * n)] <= q <= ordered[int((p + 0.011) * n)]


def test_exact_result_does_not_depend_on_partitions(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    found = {tc.fences(events.repartition(n), ["value"], rel_err=0)["value"] for n in (1, 3, 8)}
    assert len(found) == 1


CASES = {
    "spread": [float((i * 7919) % 20011) for i in range(20_000)],
    "one third equal": [5.0 if i % 3 == 0 else float(i) for i in range(20_000)],
    "all equal": [1.0] * 5000,
    "two values": [0.0, 1.0] * 3000,
    "heavy tail": [2.0 ** (i % 1000) * (-1) ** i for i in range(10_000)],
    "infinite ends": [float("-inf"), float("inf")] * 1500 + [float(i) for i in range(3000)],
    "missing": [None if i % 2 else float(i % 700) for i in range(9000)],
}


@pytest.mark.parametrize("name", CASES)
def test_search_by_counting_scans(spark, monkeypatch, name):
    """With a tiny window limit the search has to narrow many times and still lands exactly."""
    monkeypatch.setattr(quantiles, "WINDOW_ROWS", 3)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 40)
    values = CASES[name]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = tc.exact_quantiles(frame(spark, values, 3), ["x"], probs)["x"]
    assert found == [by_sorting(values, p) for p in probs]


@pytest.mark.parametrize("shift", [-0.15, 0.15])
def test_bad_guesses_cost_scans_but_not_exactness(spark, monkeypatch, shift):
    """Guesses off the mark put the rank below or above them; counting finds it all the same."""
    monkeypatch.setattr(quantiles, "WINDOW_ROWS", 10)
    good, wrong = quantiles._guess, [0]

    def bad(values, wide):
        if wrong[0] == 2:
            return good(values, wide)
        wrong[0] += 1
        moved = [replace(s, rank=s.rank + int(shift * s.inside)) for s in wide]
        return good(values, moved)

    monkeypatch.setattr(quantiles, "_guess", bad)
    values = CASES["spread"]
    found = tc.exact_quantiles(frame(spark, values), ["x"], [0.25, 0.5, 0.75])["x"]
    assert wrong[0] == 2
    assert found == [by_sorting(values, p) for p in (0.25, 0.5, 0.75)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(allow_subnormal=False)), max_size=60))
def test_exact_quantiles_match_sorting(spark, values):
    found = tc.exact_quantiles(frame(spark, values, 2), ["x"], [0.25, 0.75])["x"]
    assert found == [by_sorting(values, 0.25), by_sorting(values, 0.75)]


def test_several_columns_share_the_scans(spark):
    df = spark.range(5000).selectExpr("id AS a", "CAST(id % 10 AS INT) AS b", "CAST(NULL AS DOUBLE) AS c")
    found = tc.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.75])
    assert found == {"a": [1249.0, 3749.0], "b": [2.0, 7.0], "c": [None, None]}
