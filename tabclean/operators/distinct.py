"""Distinct counts of many columns in one pass, exact or from stored sketches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column
from .levels import branch

LG_BUCKETS = 14  # sketches of 2**14 buckets
SKETCH_ERROR = 0.03  # relative; over three standard errors
TRACKED = 8  # values that are followed for each that can be frequent


def plain_text(df: DataFrame, col: str) -> Column | None:
    """Text that tells the values of a column apart as grouping does; None for types without such a text."""
    dtype, value = df.schema[col].dataType, column(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # -0.0 becomes 0.0
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    if isinstance(dtype, T.StringType):
        return value.cast("string") if dtype.isUTF8BinaryCollation() else None
    known = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)
    return value.cast("string") if isinstance(dtype, known) else None


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["column", "value", "rows"]
    for batch in batches:
        if not len(batch):
            continue
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([None], pa.string()), pa.array([len(batch)], pa.int64())], names
        )
        for i, values in enumerate(batch.columns):
            found = pc.drop_null(pc.unique(values))
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(i, pa.int32()), len(found)), found, pa.repeat(pa.scalar(0, pa.int64()), len(found))],
                    names,
                )


def counted_distinct(texts: DataFrame) -> DataFrame:
    """One row for a frame of text columns: ``rows`` and the distinct values ``d0``, ``d1``, ... that are not null.

    A batch gives each of its values once, so a row isn't repeated for every column. Only values
    that differ inside their batches reach the grouping, which collapses them again in its task.
    """
    seen = texts.mapInArrow(_first_seen, "column int, value string, rows long")
    once = seen.groupBy("column", "value").agg(F.sum("rows").alias("rows"))
    return once.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.count_if(F.col("column") == i).alias(f"d{i}") for i in range(len(texts.columns))],
    )


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mergeable sketches of the distinct values of each column: a row per group of ``by`` with the
    group, ``rows`` and ``<col>_sketch`` (binary, at most 16 kB each).

    Store them and later tables need no second reading: :func:`merge_distinct_sketches` counts the
    union of any rows. Nulls are not counted; a group without values has an empty sketch. One narrow
    shuffle of sketches, whatever the number of values.
    """
    texts = _texts(df, cols)
    sketches = [F.hll_sketch_agg(t, F.lit(LG_BUCKETS)).alias(f"{c}_sketch") for c, t in zip(cols, texts)]
    return df.groupBy(*map(column, by)).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merge_distinct_sketches(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows`` and ``<col>_distinct`` of the union of the stored sketches, for each group of ``by``.

    The relative error has a standard deviation of 0.7%, and is rarely over ``SKETCH_ERROR``.
    """
    counts = [
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(column(f"{c}_sketch"))), F.lit(0)).alias(f"{c}_distinct")
        for c in cols
    ]
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    return sketches.groupBy(*map(column, by)).agg(rows, *counts)


def frequent_values(df: DataFrame, cols: Sequence[str], share: float = 0.001) -> DataFrame:
    """The values that make up at least ``share`` of the rows, with exact frequencies: column_name, value
    (text), rows. Null is a value like others.

    A first scan follows the hashes of at most ``8 / share`` values of each column, in sketches whose
    error is under half of ``share``, so no value that belongs in the result is lost. A second scan counts
    exactly those that are left, a bounded table that is joined by broadcast; other values are
    dropped before the shuffle. For columns whose whole value report would be as large as the table.
    """
    if not 1e-5 <= share <= 1:
        raise ValueError("share must lie between 0.00001 and 1")
    texts = _texts(df, cols)
    most = max(16, int(TRACKED / share))
    hashes = df.select(
        branch().alias("branch"), *[F.xxhash64(t.isNull(), t).alias(f"h{i}") for i, t in enumerate(texts)]
    )
    first = hashes.groupBy("branch").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k_accumulate(h{i}, {most})").alias(f"s{i}") for i in range(len(cols))],
    )
    # Grouped, because a partition without sketches must not join in: its empty one cannot be combined
    merged = first.groupBy(F.lit(0).alias("all")).agg(
        F.sum("rows").alias("total"),
        *[F.expr(f"approx_top_k_combine(s{i}, {most})").alias(f"s{i}") for i in range(len(cols))],
    )
    followed = [
        F.expr(f"transform(approx_top_k_estimate(s{i}, {most}), x -> struct({i} as place, x.item as hash))")
        for i in range(len(cols))
    ]
    left = merged.select("total", F.inline(F.flatten(F.array(*followed))))
    pairs = [F.struct(F.lit(i).alias("place"), t.alias("value"), F.xxhash64(t.isNull(), t).alias("hash")) for i, t in enumerate(texts)]
    rows = df.select(F.inline(F.array(*pairs)))
    counted = rows.join(F.broadcast(left), ["place", "hash"]).groupBy("place", "value").agg(
        F.count(F.lit(1)).alias("rows"), F.max("total").alias("total")
    )
    names = F.array(*map(F.lit, cols))
    return counted.where(F.col("rows") >= F.col("total") * share).select(
        F.element_at(names, F.col("place") + 1).alias("column_name"), "value", "rows"
    )


def _texts(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    texts = [plain_text(df, c) for c in cols]
    for c, text in zip(cols, texts):
        if text is None:
            raise TypeError(f"values of {c!r} have no one-to-one text form")
    return texts
