"""Cleaning of values. Each operator is one projection, however many columns it touches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column, is_blank, standardized, trimmed


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove leading and trailing spaces; non-text columns become text."""
    return df.withColumns({c: trimmed(c) for c in cols})


def standardize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower-case and trim; non-text columns become text."""
    return df.withColumns({c: standardized(c) for c in cols})


def blank_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace blank text by null and leave every other value as it is, padding included."""
    return df.withColumns({c: F.when(is_blank(c), None).otherwise(column(c)) for c in cols})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the given Spark types."""
    return df.withColumns({c: column(c).cast(t) for c, t in types.items()})
