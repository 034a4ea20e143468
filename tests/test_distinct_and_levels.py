"""Distinct counts in one pass, stored sketches, frequent values, quantiles merged in levels."""

import random

import pytest
from pyspark.sql import functions as F

import tabclean as tc
from tabclean.operators.levels import merged_quantiles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_do_not_repeat_rows(spark):
    df = spark.range(0, 3000, 1, 3).select(*[(F.col("id") % (i + 2)).alias(f"c.{i}") for i in range(50)])
    found = tc.distinct_counts(df, df.columns)
    assert "Expand" not in plan(found) and "Generate" not in plan(found)
    assert found.columns == [f"c.{i}_distinct" for i in range(50)]
    assert list(found.first()) == [i + 2 for i in range(50)]


def test_distinct_counts_of_every_plain_type(spark):
    rows = [(0.0, float("nan"), None, b"a", True, "x"), (-0.0, float("nan"), None, b"", None, "x "), (1.5, 2.0, None, None, False, "")]
    df = spark.createDataFrame(rows, "a double, b float, c int, d binary, e boolean, f string")
    df = df.withColumns({"g": F.lit("2024-01-01").cast("date"), "h": F.lit("2024-10-27 01:30:00").cast("timestamp")})
    df = df.withColumn("i", F.array("a"))
    plain = [c for c in df.columns if c != "i"]
    assert list(tc.distinct_counts(df, plain).first()) == [2, 2, 0, 2, 2, 3, 1, 1]
    assert list(tc.distinct_counts(df, [*plain, "i"]).first())[:8] == [2, 2, 0, 2, 2, 3, 1, 1]
    assert list(tc.cardinality_ratios(df, ["c", "f"]).first()) == [0.0, 1.0]
    empty = df.limit(0)
    assert list(tc.distinct_counts(empty, plain).first()) == [0] * 8
    assert list(tc.cardinality_ratios(empty, ["c", "f"]).first()) == [None, None]


@pytest.mark.parametrize("distinct", [1, 100, 20_000, 200_000])
def test_stored_sketches_keep_their_error(spark, distinct):
    df = spark.range(0, 2 * distinct, 1, 4).selectExpr(
        f"id % {distinct} as a", f"concat('v', id % {distinct}) as b", "id % 3 as part", "cast(null as int) as n"
    )
    stored = tc.distinct_sketches(df, ["a", "b", "n"], ["part"])
    assert stored.count() == min(3, 2 * distinct)
    found = tc.merge_distinct_sketches(stored, ["a", "b", "n"]).first()
    assert found["rows"] == 2 * distinct and found["n_distinct"] == 0
    assert abs(found["a_distinct"] - distinct) <= 0.03 * distinct
    assert abs(found["b_distinct"] - distinct) <= 0.03 * distinct


def test_stored_sketches_of_an_empty_table(spark):
    stored = tc.distinct_sketches(spark.range(0).selectExpr("id as a"), ["a"])
    assert tuple(tc.merge_distinct_sketches(stored, ["a"]).first()) == (0, 0)


def brute(values, share):
    return {v: n for v in set(values) if (n := values.count(v)) >= share * len(values)}


@pytest.mark.parametrize("parts", [1, 5])
def test_frequent_values(spark, parts):
    picker = random.Random(parts)
    values = [picker.choice(["hot", None, "", "warm"]) if picker.random() < 0.3 else f"v{picker.randrange(1500)}" for _ in range(6000)]
    values += ["edge"] * 60  # about the share itself
    picker.shuffle(values)
    numbers = [len(v or "") for v in values]
    df = spark.createDataFrame(list(zip(values, numbers)), "`a.b` string, n int").repartition(parts)
    for share in (0.2, 0.01, 0.0002):
        found = tc.frequent_values(df, ["a.b", "n"], share).collect()
        assert {r["value"]: r["rows"] for r in found if r["column_name"] == "a.b"} == brute(values, share)
        want = {str(k): n for k, n in brute(numbers, share).items()}
        assert {r["value"]: r["rows"] for r in found if r["column_name"] == "n"} == want


def test_frequent_values_with_partitions_that_hold_no_sketch(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, ("40", "false")):
            spark.conf.set(name, value)
        df = spark.range(0, 100, 1, 2).selectExpr("id % 4 as a")
        assert {r["value"]: r["rows"] for r in tc.frequent_values(df, ["a"], 0.1).collect()} == dict.fromkeys("0123", 25)
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_frequent_values_edges(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert tc.frequent_values(df.limit(0), ["a"], 0.5).collect() == []
    with pytest.raises(ValueError):
        tc.frequent_values(df, ["a"], 0)
    with pytest.raises(TypeError):
        tc.frequent_values(df.select(F.array("a").alias("a")), ["a"])


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_quantiles_in_levels_keep_their_error(spark, parts):
    """Skewed, sorted input, so that every branch covers another range."""
    n = 40_000
    df = spark.range(0, n, 1, parts).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = merged_quantiles(df, {"x": probs}, 0.01).first()["x"]
    for p, value in zip(probs, found):
        assert abs(value**0.5 + 1 - max(1, p * n)) <= 0.01 * n


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 150])
def test_few_values_are_exact_in_any_partitioning(spark, n):
    for parts in (1, 3):
        df = spark.range(0, n, 1, parts).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
        row = merged_quantiles(df, {"x": [0.25, 0.75], "y": [0.5]}, 0.01).first()
        assert row["x"] == [-(-n // 4) - 1.0, -(-3 * n // 4) - 1.0] and row["y"] is None


def test_no_sketch_without_groups(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x")
    found = plan(tc.quantile_bounds(df, ["x"]))
    for part in found.split("\n"):
        if "percentile_approx" in part and "Aggregate(" in part:
            assert "keys=[branch" in part
