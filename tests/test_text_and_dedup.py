from __future__ import annotations

import pytest

import tabclean as tc

NBSP = " "


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(
        [("  A b ",), ("\tA\t",), (f"{NBSP}A{NBSP}",), ("   ",), ("",), (None,)], ["t"]
    )


def values(df, col="t"):
    return [r[col] for r in df.collect()]


def test_trim_takes_spaces_only(texts):
    expected = ["A b", "\tA\t", f"{NBSP}A{NBSP}", "", "", None]
    assert values(tc.trim_columns(texts, ["t"])) == expected


def test_standardize_lowers_and_trims(texts):
    once = tc.standardize_text(texts, ["t"])
    assert values(once) == ["a b", "\ta\t", f"{NBSP}a{NBSP}", "", "", None]
    assert values(tc.standardize_text(once, ["t"])) == values(once)


def test_blank_to_null_does_not_trim(texts):
    once = tc.blank_to_null(texts, ["t"])
    assert values(once) == ["  A b ", "\tA\t", f"{NBSP}A{NBSP}", None, None, None]
    assert values(tc.blank_to_null(once, ["t"])) == values(once)


def test_numbers_become_text(spark):
    df = tc.standardize_text(spark.createDataFrame([(7,)], ["id"]), ["id"])
    assert df.dtypes == [("id", "string")] and df.first().id == "7"


def test_no_columns_is_no_change(texts):
    assert values(tc.trim_columns(texts, [])) == values(texts)


def test_cast_columns(spark):
    df = tc.cast_columns(spark.createDataFrame([(7, 1.5)], ["a", "b"]), {"a": "string", "b": "int"})
    assert df.dtypes == [("a", "string"), ("b", "int")] and tuple(df.first()) == ("7", 1)


def test_one_projection_for_many_columns(spark, plan):
    df = spark.range(10).selectExpr(*[f"cast(id as string) as c{i}" for i in range(50)])
    text = plan(tc.standardize_text(df, df.columns), run=False)
    assert text.count("Project") == 1


def test_duplicates_null_equals_null(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    once = tc.drop_duplicate_rows(df)
    assert rows(once) == [(None, None), (1, None), (1, "a")]
    assert rows(tc.drop_duplicate_rows(once)) == rows(once)
    assert rows(tc.duplicate_report(df)) == [(4, 3, 1)]
    assert rows(tc.count_copies(df)) == [(None, None, 1), (1, None, 2), (1, "a", 1)]


def test_duplicate_report_of_an_empty_table(spark, rows):
    assert rows(tc.duplicate_report(spark.createDataFrame([], "a int"))) == [(0, 0, 0)]


def test_copies_column_must_be_free(spark):
    with pytest.raises(ValueError, match="copies"):
        tc.count_copies(spark.createDataFrame([(1,)], ["copies"]))


def test_a_third_of_all_rows_equal_collapses_before_the_shuffle(spark, rows):
    df = spark.range(0, 90_000, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "'same text' AS t"
    )
    assert rows(tc.duplicate_report(df)) == [(90_000, 60_001, 29_999)]
    copies = tc.count_copies(df)
    assert rows(copies.filter("copies > 1")) == [(-1, "same text", 30_000)]
    final = copies._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in final
