"""Summaries merged in levels, so that no reducer takes the partials of all tasks.

Each task makes one partial and hands it to one of a bounded number of first-level reducers, told by
the number of its partition. What those return has a size that does not depend on the table, and the
second level merges it in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column

FIRST_LEVEL = 256  # most first-level reducers
MOST_POINTS = 1 << 17  # most values of a column that the second level sorts


def branch(reducers: int = FIRST_LEVEL) -> Column:
    """The first-level reducer of a row's task."""
    return F.spark_partition_id() % reducers


def merged_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]], rel_err: float) -> DataFrame:
    """One row with an array under each column's name: its values at the given probabilities, null
    without values. The columns must be doubles without NaN.

    A first-level reducer returns evenly spaced values of its branch, each standing for an equal
    share of the branch's rows, and all of its values where they are few. Half of ``rel_err`` goes to
    the sketches and the spacing, so the rank error stays below it; small tables are exact.
    """
    points = math.ceil(2 / rel_err)
    reducers = max(1, min(FIRST_LEVEL, MOST_POINTS // points))
    spaced = ",".join(str((j + 0.5) / points) for j in range(points))
    at = F.split(F.lit(spaced), ",").cast("array<double>")  # one literal, however many points
    cols = list(probs)
    values = df.select(branch(reducers).alias("branch"), *[column(c).alias(f"v{i}") for i, c in enumerate(cols)])
    first = values.groupBy("branch").agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(cols))],
        *[F.percentile_approx(f"v{i}", at, math.ceil(4 / rel_err)).alias(f"p{i}") for i in range(len(cols))],
    )
    picked = first.select(
        *[f"n{i}" for i in range(len(cols))], *[_points(i, points).alias(f"w{i}") for i in range(len(cols))]
    )
    merged = picked.agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(cols))],
        *[F.array_sort(F.flatten(F.collect_list(f"w{i}"))).alias(f"w{i}") for i in range(len(cols))],
    )
    return merged.select(
        *[
            F.when(F.col(f"n{i}") > 0, F.array(*[_at_rank(i, p, points) for p in probs[c]])).alias(c)
            for i, c in enumerate(cols)
        ]
    )


def _points(i: int, points: int) -> Column:
    """Values of a branch with their weights in units of 1/points rows."""
    kept = f"least(n{i}, {points})"
    picked = F.expr(
        f"transform(sequence(1L, {kept}), k -> struct("
        f"element_at(p{i}, cast(((2 * k - 1) * {points}) div (2 * {kept}) + 1 as int)) as value, "
        f"greatest(n{i}, {points}L) as weight))"
    )
    return F.when(F.col(f"n{i}") > 0, picked)


def _at_rank(i: int, prob: float, points: int) -> Column:
    """The first of the sorted values whose weights reach the rank ``ceil(prob * rows)``."""
    rank = F.greatest(F.ceil(F.lit(prob) * F.col(f"n{i}")), F.lit(1)).cast("long") * points
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("found"))

    def step(state: Column, x: Column) -> Column:
        seen = state["seen"] + x["weight"]
        reached = state["found"].isNull() & (seen >= rank)
        return F.struct(seen.alias("seen"), F.when(reached, x["value"]).otherwise(state["found"]).alias("found"))

    return F.aggregate(f"w{i}", start, step, lambda state: state["found"])
