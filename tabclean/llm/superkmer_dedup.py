"""Repeated word windows by super-k-mer partitioning.

Consecutive windows that share a minimiser travel as one packed string (words joined by one space) to
the bucket of that minimiser. There the strings are unpacked into windows, and sorting them counts
each exactly. See :mod:`windows` for the way into the buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .windows import Words, attach_spans, covered, repeated_spans, restored

WINDOW_WORDS = 35


def counted_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows per packed string, and over all windows in turn: whether it occurs more than once, and
    whether it occurs earlier. Words are numbered, so that windows are rows of numbers; equal rows are
    neighbours once the rows are sorted."""
    numbers: dict[bytes, int] = {}
    words = [[numbers.setdefault(w, len(numbers)) for w in p.split(b" ")] for p in pieces]
    sizes = np.array([len(w) for w in words], np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    repeated, later = np.zeros(total, bool), np.zeros(total, bool)
    if not total:
        return counts, repeated, later
    flat = np.concatenate([np.array(w, np.int32) for w in words])
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    starts = np.repeat(base - begin, counts) + np.arange(total)
    rows = np.lib.stride_tricks.sliding_window_view(flat, length)[starts]
    packed = np.ascontiguousarray(rows).view(np.dtype((np.void, 4 * length))).ravel()
    order = np.argsort(packed, kind="stable")
    same = np.zeros(total + 1, bool)
    same[1:-1] = packed[order][1:] == packed[order][:-1]
    later[order] = same[:-1]
    repeated[order] = same[:-1] | same[1:]
    return counts, repeated, later


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        text, spans = batch.column(names.index("text")), batch.column(names.index("spans"))
        kept, size, removed, digests = [], [], [], []
        for body, found in zip(text, spans, strict=True):
            words = body.as_buffer().to_pybytes().split() if body.is_valid else []
            at, rest = 0, []
            for a, b in covered(len(words), [(s["start"], s["start"] + s["length"]) for s in found.as_py() or []]):
                rest += words[at:a]
                at = b
            rest += words[at:]
            joined = b" ".join(rest)
            size.append(len(words))
            removed.append(len(words) - len(rest))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept.append(joined.decode() if body.is_valid else None)
        stay = [n for n in names if n not in ("k1", "k2", "spans", "text")]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(names.index(n)) for n in stay),
                pa.array(kept, pa.string()),
                pa.array(size, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=[*stay, "text", "n_words", "n_removed", "kept_sha256"],
        )


def remove_repeated_words(
    df: DataFrame, id_col: str, text_col: str, window: int = WINDOW_WORDS, keep_first: bool = False
) -> DataFrame:
    """``df`` without the words covered by windows of ``window`` words that also start elsewhere.

    Words are runs without ASCII white space, unchanged; windows never cross texts and are judged on
    the input. The text column holds the kept words joined by one space; n_words, n_removed and
    kept_sha256 are added. With ``keep_first`` the first copy of a window stays, in the order of id
    (nulls first), key and position.

    A null text stays null and has no words. Rows equal in id and text are cut alike: with
    ``keep_first`` they count as one text, else as copies of each other. Columns that bear the names
    of results are replaced; an empty table gives an empty result.
    """
    results = ["n_words", "n_removed", "kept_sha256"]
    df = df.drop(*[c for c in results if c not in (id_col, text_col)])
    shape, spans = repeated_spans(
        df, id_col, text_col, Words(window), lambda pieces: counted_windows(pieces, window), keep_first, "words"
    )
    joined = attach_spans(shape, spans)
    stay = [f for f in joined.schema.fields if f.name not in ("k1", "k2", "spans", "text")]
    schema = ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in stay), "text string", *(
            "n_words long, n_removed long, kept_sha256 string",
        )]
    )
    cut = joined.mapInArrow(_removed, schema)
    return cut.select(*restored(cut, df, id_col, text_col), *results)
