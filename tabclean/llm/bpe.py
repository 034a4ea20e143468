"""Byte-level BPE over Arrow batches with the tokenizers library.

A rank file lists byte strings by rank; any two neighbours whose joint string has a rank may merge,
lowest rank first. The library wants merges of pairs instead, so every way to cut a token into two
tokens becomes a merge with the token's rank. Bytes are written as the printable characters of the
byte-level alphabet; decoding reads that table backwards.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column
from .common import fresh, text_of
from .memo import Memo

BATCH_CHARS = 1 << 20
SPACE_RUN = re.compile(r" (?=\s|\Z)")
SAFE_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")  # a match of the split pattern always ends here


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Codec:
    """The codec of a rank file; kept for the life of a Python worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return Codec(ranks, pattern)


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        table = byte_characters()
        shown = {token: "".join(table[b] for b in token) for token in ranks}
        merges = []
        for token, _ in sorted(ranks.items(), key=lambda item: item[1]):
            cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
            pairs = [(ranks[a], ranks[b], a, b) for a, b in cuts if a in ranks and b in ranks]
            merges += [(shown[a], shown[b]) for _, _, a, b in sorted(pairs)]
        vocab = {shown[token]: rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.memo = Memo(self._encode_pieces)
        most = max(ranks.values(), default=-1) + 1
        self.byte_of = {c: b for b, c in enumerate(table)}
        by_id: list[bytes] = [b""] * most
        for text, rank in vocab.items():
            by_id[rank] = bytes(self.byte_of[c] for c in text)
        self.sizes = np.array([len(t) for t in by_id], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(one.ids, np.int32).tobytes() for one in found]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Pieces that recur are looked up, all others go to the library at once."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        total = 0

        def settle() -> None:
            self.memo.fill(pieces for _, pieces in waiting)
            for i, pieces in waiting:
                out[i] += map(self.memo.__getitem__, pieces)
            waiting.clear()

        for i, text in enumerate(texts):
            for part in safe_parts(text):
                waiting.append((i, split_at_spaces(part)))
                total += len(part)
                if total > BATCH_CHARS:
                    settle()
                    total = 0
        settle()
        return [np.frombuffer(b"".join(found), np.int32) for found in out]

    def encode_with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the characters [start, end) that each token's bytes lie in.

        A token may hold only a part of a character; its span then covers that whole character.
        """
        ids = self.encode_batch([text])[0]
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        char_of = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        if not len(ids):
            return ids, starts, ends
        return ids, char_of[starts], char_of[ends - 1] + 1

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids, whole even if it starts or ends inside a character."""
        sizes = self.sizes[ids]
        if not sizes.sum():
            return b""
        ends = np.cumsum(sizes)
        at = np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.bytes[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Text; bytes of a character that was cut off become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


def safe_parts(text: str) -> Iterator[str]:
    """``text`` in parts that encode as the whole does: cut only between a letter and a space that a
    letter follows, and only if it is long."""
    start = 0
    while len(text) - start > BATCH_CHARS:
        cut = SAFE_CUT.search(text, start + BATCH_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def split_at_spaces(text: str) -> list[str]:
    """``text`` in pieces that begin at a single space before a visible character.

    The split pattern takes such a space together with what follows and never looks across it, so
    the pieces encode on their own. All other white space stays inside its piece.
    """
    first, *rest = text.split(" ")
    if SPACE_RUN.search(text) is None:
        return [first, *[f" {piece}" for piece in rest]]
    pieces = [first]
    for piece in rest:
        if piece and not piece[0].isspace():
            pieces.append(f" {piece}")
        else:
            pieces[-1] += f" {piece}"
    return pieces


def groups_of(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about ``BATCH_CHARS``, so that memory does not follow the batch size."""
    group, total = [], 0
    for text in texts:
        if group and total + len(text) > BATCH_CHARS:
            yield group
            group, total = [], 0
        group.append(text)
        total += len(text)
    if group:
        yield group


def encode(
    df: DataFrame, text_col: str, path: str, pattern: str, out_col: str = "ids", offsets: bool = False
) -> DataFrame:
    """``df`` with the token ids of each whole text (array of int); null counts as empty.

    With ``offsets`` also ``<out_col>_start`` and ``<out_col>_end``: the characters each token lies
    in. No shuffle; every row is kept, repeated ones too. ``path`` is read on each executor.
    """
    fields = [out_col, f"{out_col}_start", f"{out_col}_end"] if offsets else [out_col]
    packed = fresh(df, "packed")[0]
    kind = "struct<" + ", ".join(f"f{i}: array<int>" for i in range(len(fields))) + ">"

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for batch in batches:
            rows = []
            for group in groups_of(batch.to_pylist()):
                if offsets:
                    rows += [codec.encode_with_offsets(t) for t in group]
                else:
                    rows += [(ids,) for ids in codec.encode_batch(group)]
            columns = [
                pa.array([r[i].astype(np.int32) for r in rows], pa.list_(pa.int32()))
                for i in range(len(fields))
            ]
            yield pa.StructArray.from_arrays(columns, [f"f{i}" for i in range(len(fields))])

    df = df.withColumn(packed, run(text_of(text_col)))
    return df.withColumns({n: F.col(f"{packed}.f{i}") for i, n in enumerate(fields)}).drop(packed)


def decode(df: DataFrame, ids_col: str, path: str, pattern: str, out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each row's ids as binary; null ids give null."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for batch in batches:
            yield pa.array(
                [None if i is None else codec.decode_bytes(np.array(i, np.int64)) for i in batch.to_pylist()],
                pa.binary(),
            )

    return df.withColumn(out_col, run(column(ids_col).cast("array<int>")))


def token_digests(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """The id column, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of each
    text's round trip. Ids are digested in the task that makes them; null texts are empty, an empty
    table gives an empty result."""
    digest, text = "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>", text_of(text_col)

    @F.arrow_udf(digest)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for batch in batches:
            rows = []
            for group in groups_of(batch.to_pylist()):
                for ids in codec.encode_batch(group):
                    listed = ",".join(map(str, ids.tolist())).encode()
                    back = codec.decode_bytes(ids)
                    rows.append(
                        (len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(back).hexdigest())
                    )
            counts, listed, back = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(back, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = df.select(column(id_col), run(text).alias("digest"))
    return rows.select(column(id_col), "digest.*")
