"""Repeated substrings by longest-previous-factor arrays.

A bucket's strings are joined in the order of the table and their suffixes sorted, compared up to the
match length. For suffix i, the nearest smaller text positions before and after it in suffix order
are its candidates for an earlier match; the longest common prefix with either is its longest
previous factor. Where that reaches the match length the window at i is a later copy, and the
candidate's window is what it copies.

Texts are shared out to buckets by :mod:`windows`, which sends equal windows to the same bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import Bytes, attach_spans, covered, repeated_spans, restored

MATCH_BYTES = 200


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """For each position the rank of the ``length`` bytes there (zeros beyond the end), by prefix
    doubling: ranks of 8 bytes, 16, 32, and at last two that overlap."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    rank = np.zeros(n, np.uint64)
    have = min(8, length)
    for i in range(have):
        rank = (rank << np.uint64(8)) | padded[i : i + n]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    while have < length:
        step = min(have, length - have)
        follow = np.zeros(n, np.uint64)
        follow[: n - step] = rank[step:] + np.uint64(1)
        rank = np.unique((rank << np.uint64(32)) | follow, return_inverse=True)[1].astype(np.uint64)
        have += step
    return rank


def nearest_smaller(values: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order the nearest place before and after it with a smaller value, as
    long as all neighbours in between are the ``same`` (common prefixes long enough); else -1.

    ``same[i]`` tells it of places i and i + 1. All places jump at once, each over what its candidate
    has already found to be greater, so the rounds grow with the logarithm.
    """

    def before(values: np.ndarray, joined: np.ndarray) -> np.ndarray:
        n = len(values)
        found = np.arange(-1, n - 1)
        found[1:][~joined] = -1
        while True:
            wrong = np.flatnonzero((found >= 0) & (values[found] > values))
            if not len(wrong):
                return found
            # A candidate that is settled or not: its own candidate is further out and not greater
            found[wrong] = found[found[wrong]]

    back = before(values, same)
    ahead = before(values[::-1], same[::-1])[::-1]
    return back, np.where(ahead >= 0, len(values) - 1 - ahead, -1)


def repeated_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows per piece, and over all windows in turn: whether it occurs elsewhere, and whether it
    occurs earlier, as longest previous factors of the joined pieces tell."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    repeated, later = np.zeros(total, bool), np.zeros(total, bool)
    if not total:
        return counts, repeated, later
    data = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    starts = np.repeat(base - begin, counts) + np.arange(total)  # of the windows, in the joined text
    rank = prefix_ranks(data, length)[starts]
    order = np.argsort(rank, kind="stable")
    same = rank[order][1:] == rank[order][:-1]
    back, ahead = nearest_smaller(starts[order], same)
    source = np.where(back >= 0, back, ahead)  # a longest previous factor of at least ``length``
    copy = source >= 0
    later[order[copy]] = True
    repeated[order[copy]] = True
    repeated[order[source[copy]]] = True
    return counts, repeated, later


RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _removed(match: int, with_text: bool):
    """Tasks that cut the spans out of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            text, spans = batch.column(names.index("text")), batch.column(names.index("spans"))
            kept, size, removed, runs, digests = [], [], [], [], []
            for body, found in zip(text, spans, strict=True):
                data = body.as_buffer().to_pybytes() if body.is_valid else b""
                cuts = covered(len(data), [(s["start"], s["start"] + s["length"]) for s in found.as_py() or []])
                at, rest = 0, []
                for a, b in cuts:
                    rest.append(data[at:a])
                    at = b
                rest = b"".join([*rest, data[at:]]) if cuts else data
                size.append(len(data))
                removed.append(len(data) - len(rest))
                runs.append(len(cuts))
                digests.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest.decode("utf-8", errors="ignore") if body.is_valid else None)
            columns = [
                pa.array(size, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(digests, pa.string()),
            ]
            stay = [n for n in names if n not in ("k1", "k2", "spans", "text")]
            bodies = [pa.array(kept, pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(n)) for n in stay), *bodies, *columns],
                names=[*stay, *(["text"] if with_text else []), *RESULTS],
            )

    return run


def remove_repeats(
    df: DataFrame,
    id_col: str,
    text_col: str,
    match: int = MATCH_BYTES,
    keep_first: bool = True,
    with_text: bool = True,
) -> DataFrame:
    """``df`` without the bytes covered by strings of ``match`` bytes that also start elsewhere.

    With ``keep_first`` the first copy stays, in the order of id (nulls first), key and position; else
    all copies go. Overlapping matches count, matches never cross texts, and all are judged on the
    input. Adds n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that stay); with
    ``with_text`` the text column holds what stays, less the parts of a character that was cut.

    A null text stays null and counts as empty. Rows equal in id and text are cut alike: with
    ``keep_first`` they count as one text, else as copies of each other. Columns that bear the names
    of results are replaced; an empty table gives an empty result.
    """
    df = df.drop(*[c for c in RESULTS if c not in (id_col, text_col)])
    unit = Bytes(match)
    shape, spans = repeated_spans(
        df, id_col, text_col, unit, lambda pieces: repeated_windows(pieces, match), keep_first, "suffix"
    )
    joined = attach_spans(shape, spans)
    stay = [f for f in joined.schema.fields if f.name not in ("k1", "k2", "spans", "text")]
    schema = ", ".join(
        [
            *(f"{f.name} {f.dataType.simpleString()}" for f in stay),
            *(["text string"] if with_text else []),
            "n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        ]
    )
    cut = joined.mapInArrow(_removed(match, with_text), schema)
    back = restored(cut, df, id_col, text_col) if with_text else restored(cut, df.drop(text_col), id_col, text_col)
    return cut.select(*back, *RESULTS)
