"""Windows of texts that occur more than once, found through super-k-mers.

The minimiser of a window of W units (bytes or words) is the least hash of the k-unit strings in it.
Equal windows have equal minimisers, and consecutive windows mostly share theirs, so a run of them
travels as one row: a super-k-mer. Grouping by minimiser brings all equal windows together.

1. Every super-k-mer becomes a row of numbers: where it is, its minimiser, a digest of its string.
   Minimisers that occur once are dropped; most of the text ends here, without being moved.
2. Super-k-mers with the same string are repeated in all their windows. One of each stands for all.
3. Where a minimiser has several strings, these (one of each) are fetched from the texts and sent to
   a bucket by minimiser, which compares their windows exactly.

A minimiser with more than ``GROUP_MOST`` occurrences is dealt over several buckets by a salt. Most
of its windows meet a copy in their own bucket. Each such bucket then tells the digests of its
distinct windows, once each, and counting those finds copies in other buckets; so a digest comes at
most once from a bucket, however many texts hold the window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize, staged
from .common import CHUNK, flat, row_key, texts
from .memo import Memo

GROUP_MOST = 4096
LIST_MOST = 128
BUCKET_BYTES = 1 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)
PLACE = np.uint64(CHUNK * 2 - 1)  # low bits that hold a place inside a chunk


@dataclass
class Block:
    """Texts, or parts of long ones, side by side: ``bounds`` are their ends in units, ``rows`` and
    ``bases`` tell the row and the first unit of each, ``cut`` gives the bytes of units [a, b)."""

    rows: list[int]
    bases: list[int]
    bounds: np.ndarray
    codes: np.ndarray
    cut: Callable[[int, int], bytes]


class Unit(Protocol):
    """What windows are made of."""

    window: int
    k: int

    def blocks(self, array: pa.Array) -> Iterator[Block]: ...

    def cutter(self, text: bytes) -> Callable[[int, int], bytes]: ...

    def windows(self, piece: bytes) -> list[bytes]: ...


def _parts(size: int, window: int) -> Iterator[tuple[int, int]]:
    """[a, b) of the parts of a text of ``size`` units; every window lies in exactly one part."""
    for a in range(0, size - window + 1, CHUNK - window + 1):
        yield a, min(a + CHUNK, size)


class Bytes:
    """Windows of bytes."""

    def __init__(self, window: int, k: int = 32):
        self.window, self.k = window, min(k, window)
        self.table = np.random.default_rng(1).integers(1, 1 << 63, 256, np.uint64)

    def blocks(self, array: pa.Array) -> Iterator[Block]:
        data, ends = flat(array)
        waiting, total = [], 0
        for row, (start, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            for a, b in _parts(end - start, self.window):
                if waiting and total + b - a > CHUNK:
                    yield self._block(data, waiting)
                    waiting, total = [], 0
                waiting.append((row, a, start + a, start + b))
                total += b - a
        if waiting:
            yield self._block(data, waiting)

    def _block(self, data: np.ndarray, parts: list[tuple]) -> Block:
        joined = np.concatenate([data[a:b] for *_, a, b in parts])
        bounds = np.cumsum([0, *(b - a for *_, a, b in parts)])
        raw = joined.tobytes()
        return Block(
            [p[0] for p in parts], [p[1] for p in parts], bounds, self.table[joined], lambda a, b: raw[a:b]
        )

    def cutter(self, text: bytes) -> Callable[[int, int], bytes]:
        return lambda a, b: text[a:b]

    def windows(self, piece: bytes) -> list[bytes]:
        return [piece[i : i + self.window] for i in range(len(piece) - self.window + 1)]


class Words:
    """Windows of words: runs without ASCII white space, joined by one space."""

    def __init__(self, window: int, k: int = 8):
        self.window, self.k = window, min(k, window)
        self.memo = None

    def blocks(self, array: pa.Array) -> Iterator[Block]:
        if self.memo is None:
            self.memo = Memo(lambda words: [xxhash.xxh3_64_intdigest(w) for w in words])
        most = CHUNK // 4
        waiting, total = [], 0
        for row, text in enumerate(texts(array)):
            words = text.split()
            for a, b in _parts(len(words), self.window):
                if waiting and total + b - a > most:
                    yield self._block(waiting)
                    waiting, total = [], 0
                waiting.append((row, a, words[a:b]))
                total += b - a
        if waiting:
            yield self._block(waiting)

    def _block(self, parts: list[tuple]) -> Block:
        words = [w for *_, some in parts for w in some]
        self.memo.fill([words])
        codes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
        stops = ends.tolist()
        raw = b" ".join(words)
        bounds = np.cumsum([0, *(len(some) for *_, some in parts)])
        return Block(
            [p[0] for p in parts], [p[1] for p in parts], bounds, codes,
            lambda a, b: raw[starts[a] : stops[b - 1]],
        )

    def cutter(self, text: bytes) -> Callable[[int, int], bytes]:
        words = text.split()
        return lambda a, b: b" ".join(words[a:b])

    def windows(self, piece: bytes) -> list[bytes]:
        words = piece.split(b" ")
        return [b" ".join(words[i : i + self.window]) for i in range(len(words) - self.window + 1)]


def super_kmers(
    codes: np.ndarray, bounds: np.ndarray, window: int, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each run of windows with one minimiser.

    Windows cross no bound. Of equal hashes the leftmost is the minimiser, so equal windows have it at
    the same place and two of them are never in the same run.
    """
    none = np.zeros(0, np.int64)
    if len(codes) < window:
        return none, none, np.zeros(0, np.uint64)
    # Hash of k units: doubling, then the two overlapping halves of a k that is no power of two
    value, length, power = codes * MULT + np.uint64(1), 1, MULT
    while 2 * length <= k:
        value = value[:-length] * power + value[length:]
        length, power = 2 * length, np.uint64(int(power) ** 2 & (1 << 64) - 1)
    if length < k:
        value = value[: len(value) - (k - length)] * power + value[k - length :]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    ranked = ((value * MULT) & ~PLACE) | np.arange(len(value), dtype=np.uint64)
    # Minimum of every ``width`` neighbours: blockwise running minima from both sides
    width = window - k + 1
    count = len(value) - width + 1
    rows = -(-len(value) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = ranked
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    inside = np.ones(count, bool)
    for end in bounds[1:-1].tolist():
        inside[max(0, end - window + 1) : end] = False
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, np.zeros(0, np.uint64)
    kept = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (kept[1:] != kept[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(at)))
    return at[first], sizes, value[(kept[first] & PLACE).astype(np.int64)]


RUNS = "k1 long, k2 long, start long, n int, m long, d long"


def _scan(unit: Unit):
    """Tasks that turn (k1, k2, text) into super-k-mer rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for block in unit.blocks(batch.column(2)):
                start, n, m = super_kmers(block.codes, block.bounds, unit.window, unit.k)
                part = np.searchsorted(block.bounds, start, "right") - 1
                row = np.array(block.rows, np.int64)[part]
                place = start - block.bounds[part] + np.array(block.bases, np.int64)[part]
                stop = start + n + unit.window - 1
                cut, digest = block.cut, xxhash.xxh3_64_intdigest
                d = [digest(cut(a, b)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[row]),
                        pa.array(k2[row]),
                        pa.array(place),
                        pa.array(n.astype(np.int32)),
                        pa.array(m.view(np.int64)),
                        pa.array(np.array(d, np.uint64).view(np.int64)),
                    ],
                    names=["k1", "k2", "start", "n", "m", "d"],
                )

    return run


def _fetch(unit: Unit):
    """Tasks that cut the wanted strings out of (k1, k2, id, text, need)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = {name: i for i, name in enumerate(batch.schema.names)}
            wanted = batch.column(names["need"])
            whole = batch.column(names["text"])
            fields = wanted.values
            ends = wanted.offsets.to_numpy()
            start, n, m, salt = (fields.field(i).to_numpy() for i in range(4))
            rows, places, pieces, size = [], [], [], 0
            for row in range(len(batch)):
                cut = unit.cutter(whole[row].as_buffer().to_pybytes())
                for i in range(ends[row], ends[row + 1]):
                    a = int(start[i])
                    pieces.append(cut(a, a + int(n[i]) + unit.window - 1))
                    size += len(pieces[-1])
                    rows.append(row)
                    places.append(i)
                    if size > 4 * BUCKET_BYTES:
                        yield _fetched(batch, names, rows, m[places], salt[places], start[places], pieces)
                        rows, places, pieces, size = [], [], [], 0
            if rows:
                yield _fetched(batch, names, rows, m[places], salt[places], start[places], pieces)

    return run


def _fetched(batch, names, rows, m, salt, start, pieces) -> pa.RecordBatch:
    taken = batch.select([names["id"], names["k1"], names["k2"]]).take(pa.array(rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(m), pa.array(salt), *taken.columns, pa.array(start), pa.array(pieces, pa.binary())],
        names=["m", "salt", "id", "k1", "k2", "start", "piece"],
    )


Compare = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
SPANS = "k1 long, k2 long, start long, length long"


def _compare_buckets(unit: Unit, compare: Compare, keep_first: bool, digests: bool = False):
    """Tasks over (m, salt, id, k1, k2, start, piece), sorted: spans of units in repeated windows.

    The pieces of a (minimiser, salt) are compared together; several of them share a call. With
    ``digests`` the tasks give no spans but each distinct window of a bucket: its digest, its first
    place, and whether it is the only one of its kind there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 12):
                held.append(batch.slice(at, 1 << 12))
                size += _size(held[-1])
                if size > BUCKET_BYTES:
                    joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    m, salt = joined.column(0).to_numpy(), joined.column(1).to_numpy()
                    closed = np.flatnonzero((m != m[-1]) | (salt != salt[-1]))
                    if len(closed):
                        yield from settle(joined.slice(0, int(closed[-1]) + 1))
                        joined = joined.slice(int(closed[-1]) + 1)
                    held, size = [joined], _size(joined)
        if held:
            for one in pa.Table.from_batches(held).combine_chunks().to_batches():
                yield from settle(one)

    def settle(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # Buckets of one minimiser stay apart: within a call, pieces with equal windows must come in
        # the order of the table, and what a bucket tells must not depend on how rows are batched
        m, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((m[1:] == m[:-1]) & (salt[1:] != salt[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
            if b > a:
                yield from settle_apart(batch.slice(a, b - a))

    def settle_apart(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if keep_first:  # rows equal in id and text fetch the same strings; one of them counts
            fields = [batch.column(i).to_numpy() for i in (0, 3, 4, 5)]
            new = np.ones(len(batch), bool)
            new[1:] = np.logical_or.reduce([f[1:] != f[:-1] for f in fields])
            batch = batch.filter(pa.array(new))
        pieces = list(texts(batch.column(6)))
        counts, repeated, later = compare(pieces)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        piece = np.repeat(np.arange(len(pieces)), counts)
        place = np.arange(len(piece)) - first[piece]
        if not digests:
            hit = later if keep_first else repeated
            piece, place = piece[hit], place[hit]
            yield _spans(batch, piece, place + batch.column(5).to_numpy()[piece], unit.window)
            return
        lone = ~repeated
        for at in range(0, len(pieces), 256):
            mine = np.flatnonzero(~later[first[at] : first[at + 256] if at + 256 < len(pieces) else None])
            mine += first[at]
            if len(mine):
                yield told(batch, pieces, piece[mine], place[mine], lone[mine])

    def told(batch, pieces: list[bytes], piece, place, lone) -> pa.RecordBatch:
        windows: dict[int, list[bytes]] = {}
        found = []
        for i, at in zip(piece.tolist(), place.tolist(), strict=True):
            if i not in windows:
                windows = {i: unit.windows(pieces[i])}
            found.append(xxhash.xxh3_128_digest(windows[i][at]))
        halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        taken = batch.select([2, 3, 4]).take(pa.array(piece))
        start = place + batch.column(5).to_numpy()[piece]
        return pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), *taken.columns, pa.array(start), pa.array(lone)],
            names=["h1", "h2", "id", "k1", "k2", "start", "lone"],
        )

    return run


def _size(batch: pa.RecordBatch) -> int:
    _, ends = flat(batch.column(6))
    return int(ends[-1] - ends[0])


def _spans(batch: pa.RecordBatch, piece: np.ndarray, place: np.ndarray, window: int) -> pa.RecordBatch:
    """Runs of neighbouring windows of a piece as (k1, k2, start, length in units)."""
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(piece)))
    k1, k2 = (batch.column(i).to_numpy()[piece[first]] for i in (3, 4))
    return pa.RecordBatch.from_arrays(
        [pa.array(k1), pa.array(k2), pa.array(place[first]), pa.array(sizes.astype(np.int64) + window - 1)],
        names=["k1", "k2", "start", "length"],
    )


def shaped(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key, id and text of every row, and its other columns as c0, c1, ..., so that no name clashes."""
    keys = row_key(id_col, text_col)
    others = [c for c in df.columns if c not in (id_col, text_col)]
    return df.select(
        keys[0].alias("k1"),
        keys[1].alias("k2"),
        column(id_col).alias("id"),
        column(text_col).cast("string").alias("text"),
        *[column(c).alias(f"c{i}") for i, c in enumerate(others)],
    )


def restored(shape: DataFrame, df: DataFrame, id_col: str, text_col: str) -> list:
    """Columns of a frame made by :func:`shaped`, with the names and order of ``df``."""
    others = [c for c in df.columns if c not in (id_col, text_col)]
    place = {id_col: "id", text_col: "text"} | {c: f"c{i}" for i, c in enumerate(others)}
    return [F.col(place[c]).alias(c) for c in df.columns]


def repeated_spans(
    df: DataFrame, id_col: str, text_col: str, unit: Unit, compare: Compare, keep_first: bool, name: str
) -> tuple[DataFrame, DataFrame]:
    """``df`` as :func:`shaped`, and the spans (k1, k2, start, length) of its repeated windows.

    With ``keep_first`` the first occurrence of each window, by (id, key, start), is not in a span.
    Spans may overlap. Rows that are equal in id and text have one key, and one is as repeated as the
    other. The table of super-k-mers is removed again; two small tables stay in the scratch folder.
    """
    spark = df.sparkSession
    shape = shaped(df, id_col, text_col)
    kind = shape.schema["id"].dataType.simpleString()
    scanned = shape.select("k1", "k2", "text").mapInArrow(_scan(unit), RUNS)
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    with staged(scanned, f"{name}-runs") as runs:
        counts = runs.groupBy("m").agg(
            F.count(F.lit(1)).alias("times"), (F.min("d") != F.max("d")).alias("mixed")
        )
        with staged(counts.where("times > 1"), f"{name}-minimisers") as often:
            found = materialize(runs.join(often, "m"), f"{name}-found")
    ids = shape.select("k1", "k2", "id").distinct() if keep_first else None
    if keep_first:
        found = materialize(found.join(ids, ["k1", "k2"]), f"{name}-found-ids")
    # Occurrences of a string in lists of about ``LIST_MOST``, dealt by a salt where it is frequent
    place = F.struct(*(["id"] if keep_first else []), "k1", "k2", "start", "n")
    spread = F.pmod(F.xxhash64("k1", "k2", "start"), F.ceil(F.col("times") / LIST_MOST)).cast("int")
    lists = found.groupBy("m", "d", spread.alias("list")).agg(
        F.collect_list(place).alias("places"), F.max("mixed").alias("mixed"), F.max("times").alias("times")
    )
    lists = materialize(lists, f"{name}-lists")
    strings = lists.groupBy("m", "d").agg(
        F.sum(F.size("places")).alias("copies"),
        F.min(F.array_min("places")).alias("first"),
        F.max("mixed").alias("mixed"),
        F.max("times").alias("times"),
    )
    strings = materialize(strings, f"{name}-strings")

    copied = strings.where("copies > 1").select("m", "d", "first")
    copies = lists.select("m", "d", "list", "places").join(copied, ["m", "d"])
    copies = copies.repartition(partitions, "m", "d", "list")  # the lists of a frequent string part again
    copies = copies.select("first", F.explode("places").alias("at"))
    if keep_first:
        copies = copies.where(F.col("at") != F.col("first"))
    length = (F.col("at.n") + (unit.window - 1)).cast("long").alias("length")
    copies = copies.select("at.k1", "at.k2", "at.start", length)

    order = ["m", "salt", "id", "k1", "k2", "start"]
    salts = F.ceil(F.col("times") / GROUP_MOST)

    def buckets(which) -> DataFrame:
        wanted = strings.where("mixed").where(which).select("m", salts.alias("salts"), "first.*")
        salt = F.pmod(F.xxhash64("k1", "k2", "start"), F.col("salts")).cast("long")
        need = F.struct("start", "n", "m", salt.alias("salt"))
        wanted = wanted.groupBy("k1", "k2").agg(F.collect_list(need).alias("need"))  # of one text
        # All columns of ``shape``, so that this join and the one in ``attach_spans`` share a shuffle
        fetched = shape.join(wanted, ["k1", "k2"]).mapInArrow(
            _fetch(unit), f"m long, salt long, id {kind}, k1 long, k2 long, start long, piece binary"
        )
        return fetched.repartition(partitions, "m", "salt").sortWithinPartitions(*order)

    compared = buckets(salts >= 1).mapInArrow(_compare_buckets(unit, compare, keep_first), SPANS)
    told = buckets(salts > 1).mapInArrow(
        _compare_buckets(unit, compare, keep_first, digests=True),
        f"h1 long, h2 long, id {kind}, k1 long, k2 long, start long, lone boolean",
    )
    here = F.struct("id", "k1", "k2", "start")
    counted = told.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("buckets"), F.min(here).alias("first"))
    apart = (told if keep_first else told.where("lone")).join(counted.where("buckets > 1"), ["h1", "h2"])
    if keep_first:
        apart = apart.where(~here.eqNullSafe(F.col("first")))
    apart = apart.select("k1", "k2", "start", F.lit(unit.window).cast("long").alias("length"))
    return shape, copies.unionByName(compared).unionByName(apart).distinct()


def attach_spans(shape: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of ``shape`` with its spans as one list, null where it has none."""
    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    return shape.join(lists, ["k1", "k2"], "left")


def covered(size: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans merged into maximal runs [a, b), in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
