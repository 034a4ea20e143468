"""Duplicates of wide rows: hash first, then move and compare only what may have a copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column

WORD = 64  # positions in a word of bits
POSITIONS = 1 << 27  # the bits that tell rows apart take 32 MB at most, whatever the table


def row_hash(df: DataFrame) -> Column:
    """64 bits of a row; equal rows have equal ones. Nulls are told from what they might collide with."""
    columns = [column(c) for c in df.columns]
    return F.xxhash64(*[c.isNull() for c in columns], *columns)


def may_repeat(df: DataFrame, hashed: Column, positions: int = POSITIONS) -> tuple[DataFrame, Column]:
    """``df`` with helper columns, and the test for rows that may have a copy. Rows that fail it have none.

    Hashes fall on ``positions`` places, and a place where two or more rows fall is marked by a
    bit. What is shuffled for that is one number a row and map task, and what is broadcast are the
    marked words of 64 bits: at most ``positions / 64`` of them.
    """
    if positions < 1 or positions > POSITIONS:
        raise ValueError(f"positions must be from 1 to {POSITIONS}")
    place, word, bits = (_unused(name, df.columns) for name in ("place", "word", "bits"))
    at = F.pmod(hashed, F.lit(positions))
    taken = df.select(at.alias(place)).groupBy(place).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(place) % WORD).cast("int"))
    marks = taken.groupBy(F.floor(F.col(place) / WORD).alias(word)).agg(F.bit_or(bit).alias(bits))
    rows = df.withColumn(place, at).withColumn(word, F.floor(F.col(place) / WORD))
    rows = rows.join(F.broadcast(marks), word, "left")
    marked = F.coalesce(F.getbit(F.col(bits), (F.col(place) % WORD).cast("int")), F.lit(0)) == 1
    return rows, marked


def drop_duplicate_wide_rows(df: DataFrame, positions: int = POSITIONS) -> DataFrame:
    """Keep one of each set of equal rows, like :func:`drop_duplicate_rows`, for wide rows that mostly
    have no copy.

    Only rows whose hash meets another's are shuffled and compared, in full; the hash decides
    nothing else, so collisions cost time and change nothing. With few copies the rows stay
    where they are. ``df`` is read three times, so hand in a stored table. Where most places are marked (about as
    many different repeated rows as ``positions``), everything is shuffled as in the plain form.
    """
    rows, marked = may_repeat(df, row_hash(df), positions)
    own = [column(c) for c in df.columns]
    alone = rows.where(~marked).select(*own)
    return alone.unionAll(rows.where(marked).select(*own).dropDuplicates())


def drop_duplicates_by(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, of the rows that agree in ``subset``, the first by ``order_by`` and then by all other
    columns, so that the result is the same whatever the partitioning. Nulls agree with each
    other and come first in the order.

    A grouping with a map-side minimum: a key that holds a third of the rows reaches its reducer
    once per map task. Columns must have types that can be compared (no maps).
    """
    if not subset:
        raise ValueError("subset must name at least one column")
    rest = [c for c in [*order_by, *df.columns] if c not in subset]
    rest = list(dict.fromkeys(rest))
    keys = [column(c) for c in subset]
    if not rest:
        return df.select(*keys).dropDuplicates().select(*[column(c) for c in df.columns])
    first = _unused("first", df.columns)
    fields = F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(rest)])
    kept = df.groupBy(*keys).agg(F.min(fields).alias(first))
    values = {c: F.col(f"{first}.c{i}") for i, c in enumerate(rest)}
    return kept.select(*[values.get(c, column(c)).alias(c) for c in df.columns])


def _unused(name: str, taken: Sequence[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name
