"""Quality reports. Each is one pass; all return whole results, so callers cut what they print."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column, is_missing, quoted
from .distinct import counted_distinct, plain_text


def row_count(df: DataFrame) -> DataFrame:
    """One row: row_count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls under each column's own name."""
    return df.agg(*[F.count_if(column(c).isNull()).alias(c) for c in df.columns])


def missing_counts(df: DataFrame) -> DataFrame:
    """One row with the number of null or blank values under each column's own name."""
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])


def missing_ratios(df: DataFrame) -> DataFrame:
    """One row with the share of null or blank values; null for an empty table."""
    rows = F.count(F.lit(1))
    return df.agg(*[F.try_divide(F.count_if(is_missing(df, c)), rows).alias(c) for c in df.columns])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column, null included."""
    return df.select(column(col)).distinct()


def _distinct(col: str, approx: bool) -> Column:
    return F.approx_count_distinct(column(col)) if approx else F.count_distinct(column(col))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with ``<col>_distinct`` for each column, nulls not counted.

    Several columns of plain types (no arrays, maps, structs or other collations) are counted in one
    pass that does not repeat the rows. Other columns are counted by Spark's own aggregate, which
    does. ``approx=True`` needs no shuffle of values.
    """
    counted = None if approx else _one_pass(df, cols)
    if counted is not None:
        return counted.select(*[F.col(f"d{i}").alias(f"{c}_distinct") for i, c in enumerate(cols)])
    return df.agg(*[_distinct(c, approx).alias(f"{c}_distinct") for c in cols])


def _one_pass(df: DataFrame, cols: Sequence[str]) -> DataFrame | None:
    """:func:`counted_distinct` where it serves: a single column isn't repeated anyway."""
    texts = [plain_text(df, c) for c in cols]
    if len(cols) < 2 or any(t is None for t in texts):
        return None
    return counted_distinct(df.select(*[t.alias(f"t{i}") for i, t in enumerate(texts)]))


def cardinality_ratios(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with ``<col>_ratio``: distinct values over rows; null for an empty table."""
    counted = None if approx else _one_pass(df, cols)
    if counted is not None:
        ratios = [F.try_divide(f"d{i}", "rows").alias(f"{c}_ratio") for i, c in enumerate(cols)]
        return counted.select(*ratios)
    rows = F.count(F.lit(1))
    return df.agg(*[F.try_divide(_distinct(c, approx), rows).alias(f"{c}_ratio") for c in cols])


def cardinality_ratio(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """One row: cardinality_ratio of one column."""
    return cardinality_ratios(df, [col], approx).toDF("cardinality_ratio")


SUMMARY = ("count", "mean", "stddev", "min", "max")


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per numeric column: column_name, count, mean, stddev, min, max.

    ``min`` and ``max`` are bigint when all the columns hold whole numbers, else double.
    """
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols)
    extreme = "bigint" if whole else "double"
    types = {"min": extreme, "max": extreme, "mean": "double"}
    wide = df.agg(*[F.struct(*_named(summary_aggregates(df, c), types)).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{quoted(c)}.*")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def summary_aggregates(df: DataFrame, col: str) -> dict[str, Column]:
    """The aggregates of :data:`SUMMARY` for a numeric column."""
    if not isinstance(df.schema[col].dataType, T.NumericType):
        raise TypeError(f"column {col!r} must be numeric")
    functions = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    return {part: f(column(col)) for part, f in zip(SUMMARY, functions)}


def _named(parts: dict[str, Column], types: dict[str, str]) -> list[Column]:
    return [(v.cast(types[k]) if k in types else v).alias(k) for k, v in parts.items()]


def text_length_stats(df: DataFrame, col: str) -> DataFrame:
    """:func:`describe_columns` of the length in characters, as column ``<col>_length``."""
    name = f"{col}_length"
    return describe_columns(df.select(F.length(column(col)).alias(name)), [name])


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a column; null is a group of its own."""
    return df.groupBy(column(col)).count()


def domain_violations(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Rows whose value is not one of ``allowed``; null never counts as a violation.

    True/False columns are compared as 1/0. In a text column checked against numbers, text that is
    not a number is a violation.
    """
    return df.filter(outside_domain(df, col, allowed))


def outside_domain(df: DataFrame, col: str, allowed: Sequence) -> Column:
    """The test behind :func:`domain_violations`."""
    dtype = df.schema[col].dataType
    numbers = all(isinstance(v, (int, float)) for v in allowed)
    value = column(col)
    if isinstance(dtype, T.BooleanType) and numbers:
        value = value.cast("int")
    if isinstance(dtype, T.StringType) and numbers:
        inside = F.coalesce(value.try_cast("double").isin(*map(float, allowed)), F.lit(False))
        return value.isNotNull() & ~inside
    return ~value.isin(*allowed)


def non_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is zero or less; null and NaN never match."""
    return df.filter(column(col) <= 0)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """The first ``n`` rows: any ``n`` without ``order_by``, the top ``n`` with it."""
    if order_by is not None:
        df = df.orderBy(order_by)
    return df.limit(n)


def sample_values(
    df: DataFrame, cols: Sequence[str], n: int = 5, order_by: Sequence[str] | str | None = None
) -> DataFrame:
    """``n`` rows of the chosen columns, for a look at their format."""
    return preview(df, n, order_by).select(*[column(c) for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Frequencies of several columns in one pass: column_name, value (text), rows.

    One grouping on (column, value) holds the distinct values, their frequencies and the distinct
    counts of all the columns at once. Hot values collapse before the shuffle. ``weight`` names a
    column of row counts to add up in place of ones.
    """
    unsafe = (
        T.FloatType, T.DoubleType, T.TimestampType, T.BinaryType,
        T.ArrayType, T.MapType, T.StructType,
    )
    for c in cols:
        if isinstance(df.schema[c].dataType, unsafe):
            raise TypeError(f"values of {c!r} have no one-to-one text form")
    ids = [weight] if weight else []
    text = df.select(*ids, *[column(c).cast("string").alias(c) for c in cols])
    long = text.unpivot(ids, [column(c) for c in cols], "column_name", "value")
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    return long.groupBy("column_name", "value").agg(rows.alias("rows"))
