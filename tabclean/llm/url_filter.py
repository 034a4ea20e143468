"""URL rules looked up in a sorted array of 64-bit digests.

The array of xxhash64 keys lies in a file that Spark ships to every executor once; tasks map it into
memory, so all workers of a machine share one copy. A batch of probes is one vectorised binary
search. A digest that is found counts only if the full string stored with it is the same.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import column
from .common import fresh, texts

MOST_BYTES = 1 << 30  # of an index that is shipped to every executor
HEADER = 32


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def build_index(rules: Sequence[Rule]) -> bytes:
    """A sorted digest array with the rules' full strings.

    Layout: four counts, sorted uint64 digests, int64 ends of the strings, and the strings
    themselves, each ``host NUL path NUL verdict``. Of rules with the same host and path, block
    wins over allow. Hosts are compared in lower case. Raises ValueError for another verdict, a NUL,
    or an index beyond ``MOST_BYTES``.
    """
    chosen: dict[tuple[str, str], str] = {}
    for rule in rules:
        if rule.verdict not in ("allow", "block") or "\0" in rule.text or not rule.host:
            raise ValueError(f"not a rule: {rule}")
        key = (lower_ascii(rule.host), rule.path)
        chosen[key] = max(rule.verdict, chosen.get(key, "allow"))
    entries = sorted(
        (xxhash.xxh64_intdigest(f"{host}\0{path}".encode()), f"{host}\0{path}\0{verdict}".encode())
        for (host, path), verdict in chosen.items()
    )
    lengths = sorted({len(path.encode()) for _, path in chosen})
    head = np.array([len(entries), len(lengths), 0, 0], np.int64)
    ends = np.cumsum([len(text) for _, text in entries], dtype=np.int64)
    blob = b"".join(
        [
            head.tobytes(),
            np.array([d for d, _ in entries], np.uint64).tobytes(),
            ends.tobytes(),
            np.array(lengths, np.int64).tobytes(),
            *(text for _, text in entries),
        ]
    )
    if len(blob) > MOST_BYTES:
        raise ValueError(f"the index takes {len(blob)} bytes; at most {MOST_BYTES} are shipped")
    return blob


def lower_ascii(text: str) -> str:
    return text.encode().lower().decode()


class Index:
    """The memory-mapped array."""

    def __init__(self, path: str):
        n, n_lengths = np.fromfile(path, np.int64, 2).tolist()
        self.digests = np.memmap(path, np.uint64, "r", HEADER, n) if n else np.zeros(0, np.uint64)
        at = HEADER + 8 * n
        self.ends = np.memmap(path, np.int64, "r", at, n) if n else np.zeros(0, np.int64)
        at += 8 * n
        self.lengths = np.fromfile(path, np.int64, n_lengths, offset=at).tolist()
        at += 8 * n_lengths
        size = int(self.ends[-1]) if n else 0
        self.strings = np.memmap(path, np.uint8, "r", at, size) if size else np.zeros(0, np.uint8)

    def entry(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return self.strings[start : int(self.ends[i])].tobytes()

    def judge(self, hosts: list[bytes], paths: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """The longest rule (its text and verdict) that fits each url, or None.

        Of two equally long rules the one with the longer host wins.
        """
        probes: list[bytes] = []
        owner: list[int] = []
        for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            while host:
                for size in self.lengths:
                    if size <= len(path):
                        probes.append(host + b"\0" + path[:size])
                        owner.append(row)
                _, _, host = host.partition(b".")
        out: list[tuple[bytes, bytes] | None] = [None] * len(hosts)
        if not probes or not len(self.digests):
            return out
        keys = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        at = np.searchsorted(self.digests, keys)
        found = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == keys)
        best: dict[int, tuple[int, int]] = {}
        for p in found.tolist():
            probe, i = probes[p], int(at[p])
            while i < len(self.digests) and self.digests[i] == keys[p]:
                host, path, verdict = self.entry(i).split(b"\0")
                if host + b"\0" + path == probe:  # else another string with the same digest
                    rank = (len(host) + len(path), len(host))
                    if rank > best.get(owner[p], (-1, -1)):
                        best[owner[p]] = rank
                        out[owner[p]] = (host + path, verdict)
                i += 1
        return out


_open: dict[str, Index] = {}


def ship(spark: SparkSession, blob: bytes) -> str:
    """Give every executor the index file through Spark; returns its name there."""
    name = f"url-index-{hashlib.sha256(blob).hexdigest()[:24]}.bin"
    if name not in _shipped(spark):
        path = os.path.join(tempfile.mkdtemp(prefix="url-index-"), name)
        with open(path, "wb") as file:
            file.write(blob)
        spark.sparkContext.addFile(path)
        atexit.register(lambda: os.path.exists(path) and os.unlink(path))
    return name


def _shipped(spark: SparkSession) -> set[str]:
    return {os.path.basename(f) for f in spark.sparkContext.listFiles}


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``.

    The host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
    path from there to ``?``, ``#`` or the end.
    """
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    none = F.lit("")
    return F.coalesce(F.translate(host, upper, low), none), F.coalesce(path, none)


def url_filter(
    df: DataFrame, rules: Sequence[Rule], url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``df`` with host, path, rule and verdict, one row in for one row out and no shuffle.

    The rule is the longest that fits, null where none does; then the verdict is ``default``, as an
    address that a block list does not hold passes. Null, empty and malformed urls have an empty host
    and no rule. Columns of ``df`` with the names of results are replaced. An empty table gives an
    empty result, an empty rule list the default for all.
    """
    name = ship(df.sparkSession, build_index(rules))
    host, path = url_parts(column(url_col).cast("string"))
    df = df.withColumns({"host": host, "path": path}).drop("rule", "verdict")
    judged = fresh(df, "judged")[0]

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        place = SparkFiles.get(name)
        if place not in _open:
            _open[place] = Index(place)
        for hosts, paths in batches:
            got = _open[place].judge(list(texts(hosts)), list(texts(paths)))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([g and g[0].decode() for g in got], pa.string()),
                    pa.array([g[1].decode() if g else default for g in got], pa.string()),
                ],
                ["rule", "verdict"],
            )

    df = df.withColumn(judged, judge("host", "path"))
    return df.withColumns(
        {"rule": F.col(f"{judged}.rule"), "verdict": F.col(f"{judged}.verdict")}
    ).drop(judged)
