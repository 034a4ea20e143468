"""Duplicates found by hash first, duplicates by key and order, and true ranks of quartiles."""

import re

import pytest
from pyspark.sql import functions as F

import tabclean as tc

ROWS = [
    (1, "a", None, [1, 2]),
    (1, "a", None, [1, 2]),
    (None, "a", 1.0, None),
    (None, "a", 1.0, None),
    (1, None, 1.0, None),
    (2, "", float("nan"), []),
    (2, "", float("nan"), []),
    (2, None, float("nan"), []),
    (3, "x" * 5000, 0.0, [3]),
    (3, "x" * 5000, -0.0, [3]),
    (3, "x" * 4999 + "y", 0.0, [3]),
    *[(i, f"only {i}", float(i), [i]) for i in range(10, 60)],
]


@pytest.fixture(scope="module")
def copies(spark):
    return spark.createDataFrame(ROWS, "place int, `Word` string, `b.c` double, bits array<int>").repartition(5)


def listed(df):
    return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


@pytest.mark.parametrize("positions", [1, 2, 7, 1 << 27])
def test_hashed_duplicates_equal_plain_ones(copies, positions):
    """One position makes every two rows collide, which must change nothing."""
    found = tc.drop_duplicate_wide_rows(copies, positions)
    assert found.columns == copies.columns
    assert listed(found) == listed(copies.dropDuplicates())


def test_hashed_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], "place long, t string")
    assert tc.drop_duplicate_wide_rows(empty).collect() == []
    same = spark.range(3000).select(F.lit("all alike").alias("t"))
    assert tc.drop_duplicate_wide_rows(same).count() == 1
    with pytest.raises(ValueError, match="positions"):
        tc.drop_duplicate_wide_rows(empty, 0)


def shuffled(df):
    """Bytes written by the shuffles of a query, from its final plan."""
    rows = df.collect()
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.length())]
    return total, len(rows)


def test_unique_rows_stay_where_they_are(spark, tmp_path):
    """A mostly unique table: the bytes shuffled fall to a small part of those of the plain form."""
    text = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(12)])
    rows = spark.range(4000).select(text.alias("text"))
    rows.unionAll(rows.limit(20)).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plain, n = shuffled(table.dropDuplicates())
    hashed, m = shuffled(tc.drop_duplicate_wide_rows(table))
    assert n == m == 4000
    assert 0 < hashed < plain / 5


def test_first_row_by_key_and_order(spark):
    rows = [(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "n"), (2, 1, "m"), (None, 9, "x"), (None, 8, None)]
    df = spark.createDataFrame(rows, "key int, turn int, first string")
    for parts in (1, 4):
        found = tc.drop_duplicates_by(df.repartition(parts), ["key"], ["turn"])
        assert found.columns == df.columns
        assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, 3, "a"), (2, None, "n"), (None, 8, None)], key=repr)
    last = tc.drop_duplicates_by(df, ["key", "turn", "first"], [])
    assert last.count() == 7
    with pytest.raises(ValueError, match="subset"):
        tc.drop_duplicates_by(df, [], ["turn"])


def test_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    text = plan(tc.drop_duplicates_by(df, ["k"], ["id"]))
    assert re.search(r"partial_min", text)


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_sketched_quartiles_hold_their_rank_error(spark, parts):
    df = spark.range(20_000).select(
        ((F.col("id") * 7919) % 20_000).cast("double").alias("v"),
        F.when(F.col("id") % 3 == 0, 5).alias("tied"),
        F.lit(None).cast("double").alias("none"),
    )
    found = {(r["column_name"], r["quartile"]): r for r in tc.quartile_ranks(df.repartition(parts), ["v", "tied", "none"], 0.01).collect()}
    assert len(found) == 6 and all(r["within"] for r in found.values())
    assert found["v", 0.25]["rows"] == 20_000 and found["none", 0.25]["rows"] == 0
    assert found["tied", 0.75]["rank_error"] == 0
    exact = tc.quartile_ranks(df, ["v"], 0).collect()
    assert [r["rank_error"] for r in exact] == [0, 0] and [r["upto"] for r in exact] == [5000, 15000]
