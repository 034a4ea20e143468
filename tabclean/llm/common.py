"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column

CHUNK = 1 << 20  # symbols handled at once inside a task


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Names like ``bases`` that clash with no column of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        while base.lower() in taken:
            base = f"_{base}"
        taken.add(base.lower())
        out.append(base)
    return out


def text_of(name: str) -> Column:
    """The text of a column; null counts as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that stand for (id, text). Only equal rows share them, and those get equal results,
    so ids may be null or repeated."""
    return [
        F.xxhash64(F.lit(seed), column(id_col).isNull(), column(id_col), text_of(text_col))
        for seed in (1, 2)
    ]


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array, without a copy. Nulls have no bytes."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def texts(array: pa.Array) -> Iterator[bytes]:
    """The bytes of each text in turn; only one is copied at a time."""
    data, ends = flat(array)
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield data[start:end].tobytes()


def span_groups(sizes: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive rows [a, b) whose sizes sum to about ``most``; a larger row stands alone."""
    a, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > a and total + size > most:
            yield a, i
            a, total = i, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)
