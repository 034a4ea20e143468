"""Proportional stratified interleaving of rows into shards, in DataFrame functions alone.

Every source is shuffled by a seeded hash and its rows are ranked; row r of n stands at the fraction
(r - 1 + u) / n with u from 0 to 1 by the row's hash, so that many small sources of one size do not
stand at one fraction. Sorting all rows by that fraction mixes the sources evenly, so cutting the order into
equal runs gives shards that all hold the mixture of the whole table.

No window ever holds a whole source or the whole table. A rank is the number of rows in earlier
cells of a fixed grid plus the rank inside the row's own cell: the grid over the hash splits even a
source that holds most rows into ``GRID`` windows, and so does the grid over the fractions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import column
from .common import fresh

GRID = 4096


def fraction(rank: Column, total: Column, mix: Column) -> Column:
    """Where row ``rank`` of ``total`` stands, from 0 to 1. The low bits of ``mix`` spread it; its high
    bits made the rank."""
    u = (mix.bitwiseAND(F.lit((1 << 32) - 1)) + F.lit(0.5)) / F.lit(float(1 << 32))
    return (rank - 1 + u) / total


def interleave(
    df: DataFrame,
    by: str,
    key: list[str],
    shards: int,
    seed: int = 0,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """``df`` with its shard (0 to ``shards`` - 1) and its slot there (gapless from 0).

    Shards differ by at most one row. ``key`` names the columns that identify a row; rows that are
    equal in all of them are interchangeable. Null sources form a source of their own; null keys and
    repeated rows are ranked like any other. An empty table gives an empty result. A column that
    already bears the name of a result is replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop(shard_col, slot_col)
    mix, cell, rank, total, frac, spot, high, rows = fresh(
        df, "mix", "cell", "rank", "total", "frac", "spot", "high", "rows"
    )
    source = column(by)
    order = [column(k) for k in key]
    nulls = [column(k).isNull() for k in key]
    keyed = df.withColumn(mix, F.xxhash64(F.lit(seed), *nulls, *order, source))
    keyed = keyed.withColumn(cell, F.shiftrightunsigned(mix, 64 - GRID.bit_length() + 1).cast("int"))

    in_source = _ranked(keyed, [source], cell, [F.col(mix), *order], rank, total)
    placed = in_source.withColumn(frac, fraction(F.col(rank), F.col(total), F.col(mix))).withColumn(
        cell, F.least(F.floor(F.col(frac) * GRID), F.lit(GRID - 1)).cast("int")
    )
    placed = placed.drop(rank, total)
    placed = _ranked(placed, [], cell, [F.col(frac), F.col(mix), *order], spot, rows)

    at = F.col(spot) - 1
    size, longer = F.floor(F.col(rows) / shards), F.col(rows) % shards
    cut = longer * (size + 1)  # the first shards hold one row more
    late = F.floor((at - cut) / F.when(size > 0, size))
    shard = F.when(at < cut, F.floor(at / (size + 1))).otherwise(longer + late)
    begins = F.col(high) * size + F.least(F.col(high), longer)
    return (
        placed.withColumn(high, shard.cast("int"))
        .withColumn(slot_col, (at - begins).cast("long"))
        .withColumn(shard_col, F.col(high))
        .drop(mix, cell, frac, spot, rows, high)
    )


def _ranked(
    df: DataFrame, within: list[Column], cell: str, order: list[Column], rank: str, total: str
) -> DataFrame:
    """Rank from 1 in the order of (cell, order), and the number of rows, per ``within``."""
    taken = df.withColumns({rank: F.lit(0), total: F.lit(0)})
    n, before, in_cell, *names = fresh(taken, "n", "before", "in_cell", *[f"within_{i}" for i in range(len(within))])
    groups = [w.alias(name) for w, name in zip(within, names, strict=True)]
    # A row of this table for each cell in use: at most GRID for each source.
    cells = df.groupBy(*groups, F.col(cell).alias(in_cell)).agg(F.count(F.lit(1)).alias(n))
    part = [F.col(name) for name in names]
    span = Window.partitionBy(*part) if part else Window.partitionBy()
    cells = cells.withColumns(
        {
            total: F.sum(n).over(span),
            before: F.sum(n).over(span.orderBy(in_cell)) - F.col(n),
        }
    ).drop(n)
    here = Window.partitionBy(*within, F.col(cell)).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(here))
    same = F.col(cell) == F.col(in_cell)
    for w, name in zip(within, names, strict=True):
        same = same & w.eqNullSafe(F.col(name))
    joined = ranked.join(cells, same).withColumn(rank, F.col(rank) + F.col(before))
    return joined.drop(before, in_cell, *names)
