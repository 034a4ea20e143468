"""True ranks of quartiles that a sketch returned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_double, column
from .outliers import quantile_bounds

QUARTILES = ((0.25, "q1"), (0.75, "q3"))


def quartile_ranks(df: DataFrame, cols: Sequence[str], rel_err: float = 0.01) -> DataFrame:
    """How far the quartiles of :func:`quantile_bounds` are from the ranks they stand for.

    One row per column and quartile: column_name, quartile, rows (values but nulls and NaN), value,
    below (values less than it), upto (values up to it), rank_error (distance of the wanted rank
    from the ranks that the value takes, as a share of the rows) and within (rank_error is at most
    ``rel_err``). A column without values has null value and error, and is within.

    The quartiles are one row, joined by broadcast; counting is one more narrow scan of ``df``.
    """
    values = df.select(*[as_double(df, c).alias(f"c{i}") for i, c in enumerate(cols)])
    places = {f"c{i}": c for i, c in enumerate(cols)}
    bounds = quantile_bounds(values, list(places), rel_err=rel_err)
    limits = bounds.groupBy().agg(
        *[
            F.max(F.when(F.col("column_name") == c, F.col(q))).alias(f"{q}_{c}")
            for c in places
            for _, q in QUARTILES
        ]
    )
    counted = values.crossJoin(F.broadcast(limits)).agg(
        *[F.count(c).alias(f"rows_{c}") for c in places],
        *[F.max(f"{q}_{c}").alias(f"value_{q}_{c}") for c in places for _, q in QUARTILES],
        *[F.count_if(F.col(c) < F.col(f"{q}_{c}")).alias(f"below_{q}_{c}") for c in places for _, q in QUARTILES],
        *[F.count_if(F.col(c) <= F.col(f"{q}_{c}")).alias(f"upto_{q}_{c}") for c in places for _, q in QUARTILES],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(p).alias("quartile"),
            column(f"rows_{c}").alias("rows"),
            column(f"value_{q}_{c}").alias("value"),
            column(f"below_{q}_{c}").alias("below"),
            column(f"upto_{q}_{c}").alias("upto"),
        )
        for c, name in places.items()
        for p, q in QUARTILES
    ]
    ranks = counted.select(F.inline(F.array(*rows)))
    wanted = F.greatest(F.ceil(F.col("quartile") * F.col("rows")), F.lit(1))
    apart = F.greatest(F.col("below") + 1 - wanted, wanted - F.col("upto"), F.lit(0))
    error = F.when(F.col("value").isNotNull(), F.try_divide(apart, F.col("rows")))
    return ranks.withColumn("rank_error", error).withColumn(
        "within", F.coalesce(F.col("rank_error") <= rel_err, F.col("rows") == 0)
    )
