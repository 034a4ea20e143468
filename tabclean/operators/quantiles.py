"""Exact quantiles of columns of any size.

A sketch with no error keeps every value in one place, and so does the built-in exact percentile.
Here a small-error sketch only *guesses* two values around the wanted rank; one counting scan then
tells exactly how many rows lie below, on and between the guesses, and the search goes on between
them. Every scan covers all columns and quantiles and moves a fixed number of values per task. The
open interval shrinks to about 1/250 each time; its last few rows are ranked with a window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_double, column
from .levels import merged_quantiles

SKETCH_ACCURACY = 1000  # rank error of a guess: 1/1000 of the rows it covers
WINDOW_ROWS = 1 << 16  # most rows ever ranked inside one task


@dataclass(frozen=True)
class _Search:
    """Open interval (low, high) around the wanted rank, or the answer itself."""

    column: str
    index: int
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    answer: float | None = None
    done: bool = False

    @property
    def wide(self) -> bool:
        return not self.done and self.inside > WINDOW_ROWS

    def between(self) -> Column:
        v = column(self.column)
        cond = v.isNotNull()
        if self.low is not None:
            cond = cond & (v > self.low)
        if self.high is not None:
            cond = cond & (v < self.high)
        return cond


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """The value at rank ``ceil(p * n)`` for each column and probability; None without values.

    Runs Spark jobs: a count, two scans for each factor of about 250 by which the largest column
    exceeds ``WINDOW_ROWS``, and a last one. ``df`` is scanned every time, so hand in a stored
    table, not a long plan.
    """
    values = df.select(*[as_double(df, c).alias(c) for c in cols])
    sizes = values.agg(*[F.count(column(c)).alias(str(i)) for i, c in enumerate(cols)]).first()
    searches = [
        _Search(
            c, i * len(probs) + j, min(max(1, math.ceil(p * sizes[i])), sizes[i]), sizes[i], done=sizes[i] == 0
        )
        for i, c in enumerate(cols)
        for j, p in enumerate(probs)
    ]
    open_ = [s for s in searches if not s.done]  # every search is narrowed once, whatever its size
    while open_:
        narrowed = _narrow(values, open_)
        searches = [narrowed.get(s.index, s) for s in searches]
        open_ = [s for s in searches if s.wide]
    searches = _rank_rest(values, searches)
    return {c: [s.answer for s in searches if s.column == c] for c in cols}


def _guess(values: DataFrame, wide: list[_Search]) -> dict[int, tuple[float | None, float | None]]:
    """Values a little before and after each wanted rank, from one sketching scan.

    Searches in the same interval of a column share a sketch.
    """
    margin = 2 / SKETCH_ACCURACY
    spans = {}
    shared: dict[tuple, list[_Search]] = {}
    for s in wide:
        at = (s.rank - s.below) / s.inside
        spans[s.index] = (at - margin, at + margin)
        shared.setdefault((s.column, s.low, s.high), []).append(s)
    groups = list(shared.values())
    guarded = {
        str(i): F.when(group[0].between(), column(group[0].column)) for i, group in enumerate(groups)
    }
    probes = {
        str(i): [min(max(q, 0.0), 1.0) for s in group for q in spans[s.index]] for i, group in enumerate(groups)
    }
    inside = values.filter(reduce(or_, [g[0].between() for g in groups]))
    inside = inside.select(*[v.alias(i) for i, v in guarded.items()])
    row = merged_quantiles(inside, probes, 1 / SKETCH_ACCURACY).first()
    out = {}
    for i, group in enumerate(groups):
        for s, low, high in zip(group, row[i][::2], row[i][1::2]):
            before, after = spans[s.index]
            out[s.index] = (low if before > 0 else s.low, high if after < 1 else s.high)
    return out


def _narrow(values: DataFrame, wide: list[_Search]) -> dict[int, _Search]:
    """Guess, then count rows below, on and between the guesses in one scan."""
    guesses = _guess(values, wide)
    trial = {s.index: replace(s, low=guesses[s.index][0], high=guesses[s.index][1]) for s in wide}
    aggs = []
    for i, t in trial.items():
        v = column(t.column)
        under, on_low, on_high = (
            (v < t.low, v == t.low, v == t.high)
            if t.low is not None and t.high is not None
            else (v < t.low, v == t.low, F.lit(False))
            if t.low is not None
            else (F.lit(False), F.lit(False), v == t.high)
        )
        aggs += [
            F.count_if(under).alias(f"under_{i}"),
            F.count_if(on_low).alias(f"low_{i}"),
            F.count_if(t.between()).alias(f"between_{i}"),
            F.count_if(on_high).alias(f"high_{i}"),
        ]
    n = values.agg(*aggs).first()
    return {
        s.index: _locate(
            s,
            trial[s.index],
            *[n[f"{part}_{s.index}"] for part in ("under", "low", "between", "high")],
        )
        for s in wide
    }


def _locate(s: _Search, t: _Search, under: int, on_low: int, between: int, on_high: int) -> _Search:
    """Place the wanted rank by exact counts, whatever the quality of the guesses."""
    to_low = under + on_low if t.low is not None else s.below
    to_between = to_low + between
    to_high = to_between + (on_high if t.high != t.low else 0)
    if t.low is not None and s.rank <= under:
        return replace(s, high=t.low, inside=under - s.below)
    if t.low is not None and s.rank <= to_low:
        return replace(s, answer=t.low, done=True)
    if s.rank <= to_between:
        return replace(t, below=to_low, inside=between)
    if t.high is None:
        raise ValueError("the table changed between two scans")
    if s.rank <= to_high:
        return replace(s, answer=t.high, done=True)
    return replace(s, low=t.high, below=to_high, inside=s.below + s.inside - to_high)


def _rank_rest(values: DataFrame, searches: list[_Search]) -> list[_Search]:
    """Rank what is left of each open interval; none holds more than WINDOW_ROWS rows."""
    rest = [s for s in searches if not s.done]
    if not rest:
        return searches
    names = [str(s.index) for s in rest]
    keys = [F.when(s.between(), column(s.column)).alias(str(s.index)) for s in rest]
    wanted = F.create_map(*[F.lit(x) for s in rest for x in (str(s.index), s.rank - s.below)])
    ordered = Window.partitionBy("search").orderBy("value")
    hits = (
        values.filter(reduce(or_, [s.between() for s in rest]))
        .select(*keys)
        .unpivot([], names, "search", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("search", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("wanted", wanted[F.col("search")])
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("rows") < F.col("wanted")))
        .select("search", "value")
        .collect()  # one row per search
    )
    found = {int(h["search"]): h["value"] for h in hits}
    return [replace(s, answer=found[s.index], done=True) if s.index in found else s for s in searches]
