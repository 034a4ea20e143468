"""Interquartile-range outliers: fences, listing, replacing by null."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_double, column, literal_rows, quoted
from .levels import merged_quantiles
from .quantiles import exact_quantiles

FINEST_SKETCH = 1e-4  # a sketch of smaller rank error grows too large


class Fence(NamedTuple):
    """Quartiles and outlier limits of one column; all None for a column without values."""

    q1: float | None
    q3: float | None
    lower: float | None
    upper: float | None


def exact(rel_err: float) -> bool:
    """Whether a rank error asks for exact quartiles: only 0 does."""
    if rel_err != 0 and not FINEST_SKETCH <= rel_err <= 1:
        raise ValueError(f"rel_err must be 0 (exact) or lie between {FINEST_SKETCH} and 1")
    return rel_err == 0


def _sketch(df: DataFrame, cols: Sequence[str], k: float, rel_err: float) -> DataFrame:
    """One row: a struct of q1, q3, lower_bound, upper_bound under each column's name."""
    values = df.select(*[as_double(df, c).alias(c) for c in cols])
    found = merged_quantiles(values, {c: (0.25, 0.75) for c in cols}, rel_err)

    def fence(c: str) -> Column:
        q1, q3 = column(c)[0], column(c)[1]
        reach = k * (q3 - q1)
        return F.struct(
            q1.alias("q1"),
            q3.alias("q3"),
            (q1 - reach).alias("lower_bound"),
            (q3 + reach).alias("upper_bound"),
        ).alias(c)

    return found.select(*[fence(c) for c in cols])


def fences(
    df: DataFrame, cols: Sequence[str], k: float = 1.5, rel_err: float = 0.01
) -> dict[str, Fence]:
    """Fences as Python floats, so that several later queries use the very same limits.

    The sketch form is one job for all columns. ``rel_err=0`` gives exact quartiles in a few scans
    (see :func:`exact_quantiles`). Four numbers per column reach the driver.
    """
    if not cols:
        return {}
    if not exact(rel_err):
        row = _sketch(df, cols, k, rel_err).first()
        return {c: Fence(*row[c]) for c in cols}
    out = {}
    for c, (q1, q3) in exact_quantiles(df, cols, [0.25, 0.75]).items():
        if q1 is None:
            out[c] = Fence(None, None, None, None)
        else:
            reach = k * (q3 - q1)
            out[c] = Fence(q1, q3, q1 - reach, q3 + reach)
    return out


def quantile_bounds(
    df: DataFrame, cols: Sequence[str], k: float = 1.5, rel_err: float = 0.01
) -> DataFrame:
    """One row per column: column_name, q1, q3, lower_bound, upper_bound.

    NaN is left out; a column without values gets nulls. All columns share one pass.
    """
    if exact(rel_err):
        rows = [(c, *f) for c, f in fences(df, cols, k, rel_err).items()]
        return literal_rows(
            df.sparkSession,
            rows,
            "column_name string, q1 double, q3 double, lower_bound double, upper_bound double",
        )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{quoted(c)}.*")) for c in cols]
    return _sketch(df, cols, k, rel_err).select(F.inline(F.array(*rows)))


def outside_fence(
    df: DataFrame,
    cols: Sequence[str],
    k: float,
    rel_err: float,
    limits: Mapping[str, Fence] | None = None,
) -> dict[str, Column]:
    """Per column the test for lying outside its fence; null where value or fence is null."""
    if limits is None and exact(rel_err):
        limits = fences(df, cols, k, rel_err)
    if limits is not None:
        lo = {c: F.lit(limits[c].lower).cast("double") for c in cols}
        hi = {c: F.lit(limits[c].upper).cast("double") for c in cols}
    else:
        # A scalar subquery: the fences are found inside the same query, which shares any shuffle
        # below (a duplicate removal, say) instead of running it twice.
        every = F.struct(*[column(c) for c in cols]).alias("fences")
        found = _sketch(df, cols, k, rel_err).select(every).scalar()
        lo = {c: found[c]["lower_bound"] for c in cols}
        hi = {c: found[c]["upper_bound"] for c in cols}
    return {c: (column(c) < lo[c]) | (column(c) > hi[c]) for c in cols}


def iqr_outliers(
    df: DataFrame,
    col: str,
    k: float = 1.5,
    rel_err: float = 0.01,
    limits: Mapping[str, Fence] | None = None,
) -> DataFrame:
    """Rows strictly below the lower or above the upper fence; NaN counts as above.

    ``limits`` takes fences found earlier by :func:`fences`.
    """
    return df.filter(outside_fence(df, [col], k, rel_err, limits)[col])


def null_outliers(
    df: DataFrame,
    cols: Sequence[str],
    k: float = 1.5,
    rel_err: float = 0.01,
    limits: Mapping[str, Fence] | None = None,
) -> DataFrame:
    """Replace outliers by null, keeping every row and each column's type."""
    if not cols:
        return df
    out = outside_fence(df, cols, k, rel_err, limits)
    return df.withColumns({c: F.when(out[c], None).otherwise(column(c)) for c in cols})
