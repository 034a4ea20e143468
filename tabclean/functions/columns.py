"""Built-in column expressions; everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name in backticks, so that dots and quotes in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(quoted(name))


def trimmed(col: str) -> Column:
    """Value without leading and trailing spaces (the space character only)."""
    return F.trim(column(col))


def standardized(col: str) -> Column:
    """Lower-cased, trimmed value."""
    return F.lower(trimmed(col))


def is_blank(col: str) -> Column:
    """True for text that holds nothing but spaces; null for null."""
    return trimmed(col) == ""


def is_missing(df: DataFrame, col: str) -> Column:
    """Null, or blank where the column is text.

    Other types are only tested for null: a number or date is never blank, and arrays, maps and
    structs cannot be trimmed at all.
    """
    null = column(col).isNull()
    if isinstance(df.schema[col].dataType, T.StringType):
        return null | is_blank(col)
    return null


def as_double(df: DataFrame, col: str) -> Column:
    """A numeric column as double with NaN read as null, the input of every quantile."""
    dtype = df.schema[col].dataType
    if not isinstance(dtype, T.NumericType):
        raise TypeError(f"column {col!r} must be numeric, not {dtype.simpleString()}")
    value = column(col).cast("double")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few known rows as a frame built from literals, without a Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
