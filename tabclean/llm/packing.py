"""Packing of documents into token sequences by minimum bin slack.

A document's tokens are cut into full windows and a remainder. A task gathers the remainders of a
run of documents and counts them by length. For each window it looks for the multiset of remaining
lengths that comes closest to the capacity: subset sums are a bitset (bit s: some multiset of
lengths sums to s), lengths go in from the longest on, and going back through the bitsets tells how
often each length is used. One multiset serves as many windows as the counts allow. Where no
multiset fills a window, one more document is cut to fill the slack, so only the last tokens of a
run are left over; these go into sequences whose lengths are powers of two, which need no padding.

Each task packs its own rows, so there is no shuffle, and memory is bounded by ``RUN_TOKENS``.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..functions import column
from .bpe import byte_characters
from .common import span_groups, text_of, texts

RUN_TOKENS = 1 << 21  # tokens of the documents that one run packs together
PART_BYTES = 1 << 20

# How the tokenizer splits lower-cased text, for text in ISO 8859-1
_LETTER, _NUMBER, _BLANK = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe", rb"\t-\r \x85\xa0"
SPLIT = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|[" + _LETTER + rb"]+|[" + _NUMBER + rb"]|[^" + _BLANK + _LETTER + _NUMBER + rb"]+"
)
ADDED = b"<|"  # what added tokens start with; the tokenizer looks for them before all else


class Recent(dict):
    """Values of ``make`` by string. What was asked for lately stays; the rest goes, so that the
    strings and values held, old and new, take about ``most`` bytes. Long strings are never held."""

    def __init__(self, make: Callable[[bytes], bytes], most: int = 128 << 20):
        super().__init__()
        self.make, self.most, self.size, self.old = make, most, 0, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        held = len(key) + len(value) + 200  # the objects and the table's slot
        if held > self.most >> 10:
            return value
        if self.size + held > self.most >> 1:
            self.old, self.size = dict(self), 0
            self.clear()
        self.size += held
        self[key] = value
        return value


class WordCodec:
    """Ids of a tokenizer that drops white space, and whose words do not depend on one another."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = dict(enumerate(byte_characters()))
        self.parts, self.words = Recent(self._part), Recent(self._word)

    def _part(self, part: bytes) -> bytes:
        """Ids of what the tokenizer's own steps hand to its model as one piece."""
        text = part.decode("latin-1")
        if not (text.isascii() and text.isprintable()):
            text = text.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        split = self._split(word)
        if split is not None:
            return b"".join(map(self.parts.__getitem__, split))
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _split(self, text: bytes) -> list[bytes] | None:
        """The pieces of a text, or None where the tokenizer's own steps are needed: for characters
        beyond ISO 8859-1, which may compose or change their length in lower case, and added tokens."""
        if ADDED in text:
            return None
        if text.isascii():
            return SPLIT.findall(text.lower())
        try:
            narrow = text.decode()
            narrow.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return SPLIT.findall(narrow.lower().encode("latin-1"))

    def encode(self, docs: list[bytes]) -> list[np.ndarray]:
        """Ids of UTF-8 texts, whole, as the tokenizer gives them without special tokens."""
        return [np.frombuffer(b"".join(map(self._ids, spans(doc))), np.uint32) for doc in docs]

    def _ids(self, text: bytes) -> bytes:
        split = self._split(text)
        if split is None:
            return b"".join(map(self.words.__getitem__, text.split()))
        return b"".join(map(self.parts.__getitem__, split))


def spans(doc: bytes) -> Iterator[bytes]:
    """A text in runs of bounded size, cut at ASCII white space."""
    start = 0
    while len(doc) - start > PART_BYTES:
        cut = SPACE.search(doc, start + PART_BYTES)
        if cut is None:
            break
        yield doc[start : cut.start()]
        start = cut.end()
    yield doc[start:] if start else doc


SPACE = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=2)
def load(path: str) -> WordCodec:
    return WordCodec(path)


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths in ``counts`` whose sum is closest to ``capacity`` from below.

    ``reach`` has bit s set if lengths so far can sum to s. A length that is there n times enters as
    1, 2, 4, ... times itself and a rest. The search ends early once the capacity itself is reached.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, trail = 1, []
    for length in sorted((k for k in counts if k <= capacity), reverse=True):
        left, times = min(counts[length], capacity // length), 1
        while left:
            take = min(times, left)
            left -= take
            times *= 2
            trail.append((reach, length, take))
            reach = (reach | (reach << (length * take))) & mask
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for before, length, take in reversed(trail):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


def plan_windows(sizes: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token of the documents once.

    Every sequence is exactly ``capacity`` long or a power of two.
    """
    plans: list[list[tuple[int, int, int]]] = []
    waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)  # length: (document, start)
    for doc, size in enumerate(sizes.tolist()):
        plans += [[(doc, at, capacity)] for at in range(0, size - capacity + 1, capacity)]
        if rest := size % capacity:
            waiting[rest].append((doc, size - rest))
    counts = {length: len(spots) for length, spots in waiting.items()}
    total = sum(length * n for length, n in counts.items())

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return waiting[length].pop()

    while total >= capacity:
        used = best_fill(counts, capacity)
        slack = capacity - sum(length * n for length, n in used.items())
        for _ in range(min(counts[length] // n for length, n in used.items())):
            window = [(*take(length), length) for length, n in used.items() for _ in range(n)]
            if slack:
                # All remaining lengths exceed the slack, or they would have gone in
                length = min(counts)
                doc, at = take(length)
                window.append((doc, at, slack))
                counts[length - slack] = counts.get(length - slack, 0) + 1
                waiting[length - slack].append((doc, at + slack))
            plans.append(window)
            total -= capacity
            if slack:
                break
    rest = [(*take(length), length) for length in sorted(counts, reverse=True) for _ in range(counts[length])]
    return plans + _powers(rest, total)


def _powers(rest: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The last pieces in sequences of falling powers of two."""
    plans = []
    pieces = iter(rest)
    doc = at = left = 0
    for power in (1 << bit for bit in reversed(range(total.bit_length())) if total >> bit & 1):
        window, room = [], power
        while room:
            if not left:
                doc, at, left = next(pieces)
            size = min(room, left)
            window.append((doc, at, size))
            at, left, room = at + size, left - size, room - size
        plans.append(window)
    return plans


def pack(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    A document is its text's ids and ``end_id``; null text counts as empty, so every row has a token.
    Columns: the id, start, length, ids_crc32 (of the ids as little-endian unsigned 32 bits),
    doc_tokens, sequence_id, offset, and input_ids. Repeated rows and null ids are packed like any
    other, other columns are left out, an empty table gives an empty result. ``capacity`` must be a
    power of two. Sequence ids are unique, not consecutive.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, input_ids binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        first = TaskContext.get().partitionId() << 36
        ids, tokens, total = [], [], 0
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            sizes = np.array([len(t) for t in texts(batch.column(1))], np.int64)
            for a, b in span_groups(sizes):
                found = codec.encode(list(texts(batch.column(1).slice(a, b - a))))
                for id_, one in zip(batch.column(0).slice(a, b - a).to_pylist(), found, strict=True):
                    ids.append(id_)
                    tokens.append(np.append(one, np.uint32(end_id)))
                    total += len(one) + 1
                if total > RUN_TOKENS:
                    out, first = _packed(ids, tokens, capacity, first, id_type)
                    yield out
                    ids, tokens, total = [], [], 0
        if ids:
            yield _packed(ids, tokens, capacity, first, id_type)[0]

    rows = df.select(column(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _packed(
    ids: list, tokens: list[np.ndarray], capacity: int, first: int, id_type: pa.DataType
) -> tuple[pa.RecordBatch, int]:
    plans = plan_windows(np.array([len(t) for t in tokens], np.int64), capacity)
    rows: list[tuple] = []
    for sequence, window in enumerate(plans, first):
        offset = 0
        for doc, start, length in window:
            raw = tokens[doc][start : start + length].astype("<u4").tobytes()
            rows.append((ids[doc], start, length, zlib.crc32(raw), len(tokens[doc]), sequence, offset, raw))
            offset += length
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "input_ids"]
    types = [id_type, *[pa.int64()] * 6, pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names), first + len(plans)
