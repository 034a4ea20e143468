"""Homomorphic multiset hash of a text's paragraphs.

Each paragraph becomes a wide vector of +1 and -1 from a 128-bit hash, and a text's fingerprint is
the sum of its paragraphs' vectors, lane by lane modulo 2**32. Sums do not depend on order, adding a
paragraph adds its vector and deleting one subtracts it, so a fingerprint follows edits without the
text. No text has the 2**31 paragraphs that would wrap a lane. Two different texts with the same fingerprint would need all 128 lanes to cancel.

The lanes also measure likeness: lane by lane products of two sums average to the number of shared
paragraphs (counted by multiplicity), since distinct paragraphs have independent signs.

A paragraph is a line; white space around words does not count, and a line of more than
``PIECE_WORDS`` words goes in as pieces of that many, so that texts of one long line compare as well.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column
from .common import text_of, texts

LANES = 128
PIECE_WORDS = 8
BATCH_PIECES = 1 << 15


def pieces(text: str | bytes) -> Iterator[bytes]:
    """The paragraphs of a text, long ones in pieces; blank lines do not count."""
    data = text.encode() if isinstance(text, str) else text
    for line in data.split(b"\n"):
        words = line.split()
        for i in range(0, len(words), PIECE_WORDS):
            yield b" ".join(words[i : i + PIECE_WORDS])


def fingerprint(text: str | bytes) -> np.ndarray:
    """The sum for one text: 128 lanes modulo 2**32. An empty text gives zeros."""
    return insert(np.zeros(LANES, np.uint32), pieces(text))


def insert(sums: np.ndarray, parts: Iterable[bytes]) -> np.ndarray:
    """The fingerprint after adding paragraphs."""
    out, digests = sums.copy(), []
    for part in parts:
        digests.append(xxhash.xxh3_128_digest(part))
        if len(digests) == BATCH_PIECES:
            out += _sum(digests)
            digests = []
    return out + _sum(digests)


def delete(sums: np.ndarray, parts: Iterable[bytes]) -> np.ndarray:
    """The fingerprint after removing paragraphs that are in it."""
    return sums - insert(np.zeros(LANES, np.uint32), parts)


def _sum(digests: list[bytes]) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, LANES // 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.uint32)
    return 2 * ones - np.uint32(len(digests))  # unsigned: wraps on purpose


def to_hex(sums: np.ndarray) -> str:
    return sums.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated cosine of two paragraph multisets, from 0 to 1; equal fingerprints give 1."""
    if np.array_equal(one, other):
        return 1.0
    a, b = one.view(np.int32).astype(np.float64), other.view(np.int32).astype(np.float64)
    norm = float(np.sqrt(a @ a) * np.sqrt(b @ b))
    return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0


def add_fingerprint(df: DataFrame, text_col: str, out_col: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each text as hex; null counts as empty. No shuffle."""

    @F.arrow_udf("string")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([to_hex(fingerprint(text)) for text in texts(batch)], pa.string())

    return df.withColumn(out_col, prints(text_of(text_col)))


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) characters replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Fingerprint of each text, of its edited form, and the likeness to that and to the next text.

    The next row is the one with the next lower id (after the last: the first). Null ids come last;
    rows with equal ids follow each other by a hash of their text. A table of one row is its own
    next. Null texts are empty; an empty table gives an empty result. Columns: the id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Ids may have any type that Spark and Python order alike: numbers, text, dates.

    The order takes one shuffle: rows go to ranges of (id, hash of the text), each range is a task of its
    own, and the first row of each range also goes to the range before, as the neighbour of its
    last. Tasks then stream through their range and hold two texts at a time. The first rows' ids
    and hashes, one for each shuffle partition, pass the driver.
    """
    spark = df.sparkSession
    rows = df.select(column(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("tie", F.shiftright(F.xxhash64("text"), 1))
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    heads = _heads(rows.select("id", "tie"), count)
    if not heads:
        return _result(df, id_col, rows.withColumns({"range": F.lit(0), "guest": F.lit(0)}), 1)
    edges = sorted(heads)

    @F.arrow_udf("int")
    def range_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, ties in batches:
            keys = zip(ids.to_pylist(), ties.to_pylist(), strict=True)
            places = [len(edges) - 1 - bisect_left(edges, _key(*key)) for key in keys]
            yield pa.array(places, pa.int32())

    ranged = rows.withColumn("range", range_of("id", "tie"))
    # The head of a range follows the last row of the range before; the first follows the last
    table = spark.createDataFrame(
        [(id_, -tie, (at - 1) % len(heads)) for at, (_, id_, tie) in enumerate(heads)],
        T.StructType(
            [
                T.StructField("at", df.schema[id_col].dataType),
                T.StructField("tied", T.LongType()),
                T.StructField("host", T.IntegerType()),
            ]
        ),
    )
    guests = rows.join(
        F.broadcast(table),  # a row for each range
        F.col("id").eqNullSafe(F.col("at")) & (F.col("tie") == F.col("tied")),
    ).select("id", "text", "tie", F.col("host").alias("range"), F.lit(1).alias("guest"))
    guests = guests.dropDuplicates(["range"])
    return _result(df, id_col, ranged.withColumn("guest", F.lit(0)).unionByName(guests), len(heads))


def _key(id_, tie: int) -> tuple:
    """Greater keys come first: greater ids, then lesser hashes; null ids last."""
    return (id_ is not None, id_, -tie)


def _heads(keys: DataFrame, count: int) -> list[tuple]:
    """The first key of each of at most ``count`` ranges of about equal size, in their order."""
    parts = keys.repartitionByRange(count, F.col("id").desc_nulls_last(), F.col("tie").asc())
    order = F.struct(F.col("id").isNotNull().alias("there"), F.col("id"), (-F.col("tie")).alias("tie"))
    found = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.max(order).alias("head")).collect()
    return sorted({_key(r["head"]["id"], -r["head"]["tie"]) for r in found}, reverse=True)


def _result(df: DataFrame, id_col: str, rows: DataFrame, count: int) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        "id " + kind + ", n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    sorted_rows = rows.repartitionById(count, F.col("range")).sortWithinPartitions(
        "range", "guest", F.col("id").desc_nulls_last(), "tie", "text"
    )
    return sorted_rows.select("range", "guest", "id", "text").mapInArrow(_walk, schema).withColumnRenamed("id", id_col)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # (range, id, text, fingerprint) of the row that waits for its next
    id_type = pa.int64()
    for batch in batches:
        out: list[tuple] = []
        id_type = batch.column(2).type
        ranges, guests, ids = (batch.column(i).to_pylist() for i in range(3))
        bodies = batch.column(3)
        for i, (range_, guest, id_) in enumerate(zip(ranges, guests, ids, strict=True)):
            text = bodies[i].as_py()
            sums = fingerprint(text)
            if held is not None and held[0] == range_:
                out.append(_compared(*held[1:], text, sums))
            held = None if guest else (range_, id_, text, sums)
        yield _batch(out, id_type)
    if held is not None:
        raise RuntimeError("a range has no neighbour")


def _compared(id_, text: str, sums: np.ndarray, following: str, next_sums: np.ndarray) -> tuple:
    edited = edited_text(text, following)
    edited_sums = fingerprint(edited)
    return (
        id_,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        to_hex(sums),
        to_hex(edited_sums),
        likeness(sums, edited_sums),
        likeness(sums, next_sums),
    )


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    names = [
        "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    types = [id_type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )
