"""Whole-row duplicates.

All three operators group on every column, so copies collapse before the shuffle: a row that makes
up a third of the table reaches its reducer once per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; null equals null."""
    return df.dropDuplicates()


def count_copies(df: DataFrame, name: str = "copies") -> DataFrame:
    """Distinct rows plus the number of times each occurred.

    The counts keep what duplicate removal throws away, so reports on the rows before and after
    it come from the one grouping.
    """
    if name in df.columns:
        raise ValueError(f"the table already has a column {name!r}")
    return df.groupBy(*[column(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: rows_before, rows_after, duplicates_removed."""
    copies = "__copies"
    before = F.coalesce(F.sum(copies), F.lit(0))
    after = F.count(F.lit(1))
    return count_copies(df, copies).agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("duplicates_removed"),
    )
