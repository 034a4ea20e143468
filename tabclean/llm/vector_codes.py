"""Vector compression into one small code for each part of a vector, in exact integer arithmetic.

Components become integers, vectors are cut into parts, and each part is replaced by the number of
the nearest entry of its codebook; codebooks are refined by rounds of assigning and averaging.

Distances come from dot products by floating-point matrix multiplication that is nevertheless
exact: integers are split into limbs so short that a sum of products of two limbs stays below 2^53,
and the products of all pairs of limbs are put together again in 64-bit integers. So results do
not depend on how rows are batched, ordered or dealt out to tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize

MANTISSA = 53  # integers below 2^53 are exact in float64
WORD = 1 << 62  # distances below this are computed in 64-bit integers
TOTAL = 40  # bits of a number that sums travel in, so that many of them add up in 64 bits
HOT = 1024  # a label with more than this part of the rows is joined by broadcast; fewer than HOT can be


@dataclass(frozen=True)
class CodeBooks:
    """``entries[part][entry]`` are the integers that stand for a part of a vector."""

    entries: list[list[list[int]]]
    scale: int

    def digest(self) -> str:
        """SHA-256 of all integers in order, as decimals joined by commas."""
        flat = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for: the middle of what rounds down to its integers."""
        numbers = (int(code[i : i + 2], 16) for i in range(0, len(code), 2))
        picked = [part[n] for part, n in zip(self.entries, numbers, strict=True)]
        return [(x + 0.5) / self.scale for entry in picked for x in entry]

    def arrays(self) -> list[np.ndarray]:
        return [
            _narrowed(np.array(part, object).reshape(len(part), len(part[0]) if part else 0)) for part in self.entries
        ]


def finite(vectors: str) -> Column:
    """True for vectors without null or non-finite components."""
    sound = F.forall(
        column(vectors), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return column(vectors).isNotNull() & sound


def _narrowed(numbers: np.ndarray) -> np.ndarray:
    """Python integers as 64-bit ones where they fit."""
    small = numbers.size == 0 or max(abs(int(numbers.max())), abs(int(numbers.min()))) < WORD
    return numbers.astype(np.int64) if small else numbers


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; Python integers where 64 bits are too few."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size == 0 or np.abs(scaled).max() < WORD:
        return scaled.astype(np.int64)
    # A double may overflow when scaled, an integer does not
    exact = [int(x) * scale if abs(x) >= 2**MANTISSA else int(y) for x, y in zip(values.flat, scaled.flat)]
    return np.array(exact, object).reshape(values.shape)


def limbs(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 parts of 64-bit integers, lowest first: the sum of part i times 2^(bits * i) is the
    number. All but the last lie in [0, 2^bits), the last in [-2^bits, 2^bits)."""
    out = []
    while numbers.size and (numbers.max() >= 1 << bits or numbers.min() < -(1 << bits)):
        out.append((numbers & ((1 << bits) - 1)).astype(np.float64))
        numbers = numbers >> bits
    return [*out, numbers.astype(np.float64)]


def exact_dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of 64-bit integers, exact as long as the result fits 64 bits."""
    length = max(left.shape[1], 1)
    bits = (MANTISSA - (length - 1).bit_length()) // 2
    out = np.zeros((len(left), len(right)), np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            # What leaves 64 bits here comes back when the other products are added
            if bits * (i + j) < 64:
                out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row by squared Euclidean distance, the first of several, and the
    distance."""
    most = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    if 4 * max(parts.shape[1], 1) * most * most >= WORD or parts.dtype == object or entries.dtype == object:
        wide, against = parts.astype(object), entries.astype(object)
        distance = np.array(
            [[sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in against] for x in wide], object
        ).reshape(len(wide), len(against))
    else:
        own, theirs = (parts * parts).sum(axis=1), (entries * entries).sum(axis=1)
        distance = own[:, None] + theirs[None, :] - 2 * exact_dots(parts, entries)
    first = distance.argmin(axis=1)
    return first, distance[np.arange(len(first)), first]


def _matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return integers(values.reshape(len(vectors), -1) if len(values) else np.zeros((len(vectors), 0)), scale)


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int) -> DataFrame:
    """(id, label, vector) of the rows that take part, stored for the passes to come.

    Where vectors differ in length, the most frequent length that can be cut takes part, the longest
    of several.
    """
    rows = df.where(finite(vec_col)).select(
        column(id_col).alias("id"), column(label_col).alias("label"), column(vec_col).alias("vector")
    )
    rows = materialize(rows, "codes-vectors")
    size = F.size("vector")
    sizes = rows.where(size % parts == 0).groupBy(size.alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(size == (common["size"] if common else -1))


def train_codebooks(
    rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> CodeBooks:
    """Codebooks from :func:`kept_vectors`, started from the ``entries`` smallest ids.

    Each round is one narrow pass over all rows; what reaches the driver is one total a codebook
    component.
    """
    head = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    start = [integers(np.array([r["vector"]], np.float64), scale)[0].tolist() for r in head]
    length = len(start[0]) // parts if start else 0
    books = [[v[p * length : (p + 1) * length] for v in start] for p in range(parts)]
    for _ in range(rounds if start else 0):
        totals = _totals(rows, CodeBooks(books, scale), length)
        for p, part in enumerate(books):
            for e, entry in enumerate(part):
                at = (p * len(part) + e) * (length + 1)
                if count := totals.get(at + length):
                    entry[:] = [totals.get(at + i, 0) // count for i in range(length)]
    return CodeBooks(books, scale)


def _totals(rows: DataFrame, books: CodeBooks, length: int) -> dict[int, int]:
    """Sums by cell: for each entry of each part its parts' components and their number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = books.arrays()
        cells = [np.zeros((len(c), length + 1), object) for c in codebooks]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(0), books.scale)
            for p, c in enumerate(codebooks):
                part = vectors[:, p * length : (p + 1) * length]
                code, _ = nearest(part, c)
                for e in np.unique(code):
                    mine = part[code == e]
                    cells[p][e, :length] += _column_sums(mine)
                    cells[p][e, length] += len(mine)
        out = [(i, *x) for i, total in enumerate(np.concatenate([c.ravel() for c in cells])) for x in _split(total)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["cell", "place", "value"]
            )

    found = rows.select("vector").mapInArrow(add, "cell long, place long, value long")
    totals: dict[int, int] = {}
    for r in found.groupBy("cell", "place").agg(F.sum("value").alias("value")).collect():
        totals[r["cell"]] = totals.get(r["cell"], 0) + (r["value"] << (TOTAL * r["place"]))
    return totals


def _column_sums(numbers: np.ndarray) -> np.ndarray:
    """Sums as Python integers; 64 bits hold them unless a component alone nears that."""
    if numbers.dtype != object and numbers.size and np.abs(numbers).max() * float(len(numbers)) >= WORD:
        numbers = numbers.astype(object)
    return numbers.sum(axis=0).astype(object)


def _split(total: int) -> Iterator[tuple[int, int]]:
    """(place, value) with value * 2^(TOTAL * place) adding up to ``total``; nothing for zero."""
    sign, left, place = (-1 if total < 0 else 1), abs(int(total)), 0
    while left:
        if low := left & ((1 << TOTAL) - 1):
            yield place, sign * low
        left, place = left >> TOTAL, place + 1


def encode_vectors(rows: DataFrame, books: CodeBooks) -> DataFrame:
    """(id, label, code, error) of rows from :func:`kept_vectors`: two hex digits a part, and the
    squared distance to what the code stands for, in integers; null if it exceeds 64 bits."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    parts = len(books.entries)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = books.arrays()
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(2), books.scale)
            length = vectors.shape[1] // parts
            codes = np.zeros((len(vectors), parts), np.uint8)
            error = np.zeros(len(vectors), object)
            for p, c in enumerate(codebooks):
                codes[:, p], distance = nearest(vectors[:, p * length : (p + 1) * length], c)
                error += distance
            raw = codes.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([raw[i : i + parts].hex() for i in range(0, len(raw), parts)], pa.string()),
                    pa.array([x if x < 1 << 63 else None for x in error.tolist()], pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    return rows.select("id", "label", "vector").mapInArrow(
        encode, f"id {types['id']}, label {types['label']}, code string, error long"
    )


def compress_vectors(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    label_col: str,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """Codes of all vectors: the id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Vectors that are null or hold null or non-finite components are dropped, and so are those whose
    length differs from the common one (see :func:`kept_vectors`). Null ids are coded like others, but come
    last where codebooks start; among equal ids the lesser vector comes first there. With fewer than ``entries``
    vectors each is an entry. ``label_error`` is the sum of ``error`` over the label, null labels
    together; either is null where it exceeds 64 bits. Other columns are left out. An empty table
    gives an empty result.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("entries must be from 1 to 256, and parts at least 1")
    rows = kept_vectors(df, id_col, vec_col, label_col, parts)
    books = train_codebooks(rows, parts, entries, rounds, scale)
    coded = materialize(encode_vectors(rows, books), "codes")
    summed = _with_label_error(coded)
    return summed.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of errors of a row's label. Labels with many rows, of which there can only be few,
    are looked up by broadcast, so that their rows stay where they are."""
    total = F.try_sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.when(F.count("error") == F.count(F.lit(1)), total).try_cast("long").alias("label_error"),
    )
    sums = materialize(sums, "codes-labels")
    rows = sums.agg(F.sum("rows")).first()[0] or 0
    often, seldom = (sums.where(test) for test in (F.col("rows") * HOT > rows, F.col("rows") * HOT <= rows))
    same = F.col("label").eqNullSafe(F.col("of"))
    hot = coded.join(F.broadcast(often), same)
    rest = coded.join(F.broadcast(often), same, "left_anti").join(seldom, same)
    return hot.unionByName(rest)
