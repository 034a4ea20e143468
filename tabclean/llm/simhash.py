"""SimHash near-duplicates through deletion-variant signatures.

Two 64-bit fingerprints that differ in at most d bits, cut into enough segments, agree in some
segment but for one bit at most: for d = 3, two segments of 32 bits do. Each segment is indexed once
for every bit it could differ in, with that bit cleared. Two segments within one bit share a variant,
so an equality grouping on (segment, bit, variant) brings every linked pair together at least once;
the whole fingerprints are then compared.

Only distinct fingerprints are indexed: copies ride along with their fingerprint. A group of equal
variants yields a spanning forest of its links, never all pairs. A group beyond ``GROUP_MOST``
fingerprints is not gathered; its members are indexed again by variants of the half that is still
free, which leaves 18 bits open, so that even then a task holds at most 2**18 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize
from .common import fresh, row_key, text_of, texts
from .components import connected_components

GROUP_MOST = 2048
SHINGLE_BATCH = 1 << 16
POWERS = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The SimHash of a UTF-8 text, A-Z lower-cased, over shingles of ``words`` words.

    Words are runs without space, tab, line feed, vertical tab, form feed or carriage return. Fewer
    words make one shingle; none gives 0. Repeats count. A bit is set if it is set in more than half
    of the shingles' XXH64 values.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = memoryview(b" ".join(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    count = max(1, len(found) - words + 1)
    starts = np.concatenate([[0], ends[: count - 1] + 1]).tolist()
    stops = ends[-count:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, count, SHINGLE_BATCH):
        hashes = b"".join(
            [digest(joined[a:b], seed) for a, b in zip(starts[at : at + SHINGLE_BATCH], stops[at : at + SHINGLE_BATCH], strict=True)]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * ones > count).astype(np.uint8)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def simhash(text: Column, words: int, seed: int) -> Column:
    """The fingerprint as a signed long; the text must not be null."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [fingerprint(t, words, seed) for t in texts(batch)]
            yield pa.array(np.array(values, np.uint64).astype(np.int64))

    return run(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def variants(values: np.ndarray, low: int, width: int) -> np.ndarray:
    """For each value, the segment once for each of its bits with that bit cleared (n x width)."""
    part = (values >> np.uint64(low)) & np.uint64((1 << width) - 1)
    return part[:, None] & ~(np.uint64(1) << np.arange(width, dtype=np.uint64))[None, :]


def index_rows(max_bits: int):
    """Tasks that turn fingerprints into (slot, variant, fp): slot numbers segment and bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                fps = batch.column(0).slice(at, 1 << 14).to_numpy(zero_copy_only=False).view(np.uint64)
                slot = 0
                for low, width in segments(max_bits):
                    keys = variants(fps, low, width)
                    slots = np.broadcast_to(np.arange(slot, slot + width, dtype=np.int32), keys.shape)
                    yield _rows(slots.ravel(), keys.ravel(), np.repeat(fps, width))
                    slot += width

    return run


def refine_rows(max_bits: int):
    """Tasks that index members of a large group again, by the bits outside its segment.

    There are still at most ``max_bits`` differences, in 64 - width bits cut as before, so again some
    part differs by one bit at most.
    """
    parts = segments(max_bits)
    slot_segment = [segment for segment in parts for _ in range(segment[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(0).to_numpy()
            keys, fps = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            for low, width in sorted(set(parts)):
                mine = np.isin(slots, [s for s, seg in enumerate(slot_segment) if seg == (low, width)])
                high = np.uint64(low + width) if low + width < 64 else None
                rest = fps[mine] & np.uint64((1 << low) - 1)
                if high is not None:
                    rest |= (fps[mine] >> high) << np.uint64(low)
                for k, (a, b) in enumerate(_halves(64 - width, max_bits)):
                    fine = variants(rest, a, b)
                    code = np.arange(b, dtype=np.int64) + 64 * (k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(slots[mine], b)),
                            pa.array(np.repeat(keys[mine], b).view(np.int64)),
                            pa.array(np.broadcast_to(code, fine.shape).ravel().astype(np.int32)),
                            pa.array(fine.ravel().view(np.int64)),
                            pa.array(np.repeat(fps[mine], b).view(np.int64)),
                        ],
                        names=["slot", "variant", "slot2", "variant2", "fp"],
                    )

    return run


def _halves(width: int, max_bits: int) -> list[tuple[int, int]]:
    count = max_bits // 2 + 1
    edges = [width * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _rows(slots: np.ndarray, keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(slots), pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))],
        names=["slot", "variant", "fp"],
    )


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of ``fps`` that are connected by steps of at most ``max_bits``."""
    left, ones, others = fps, [], []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = np.bitwise_count(left ^ one) <= max_bits
            if near.any():
                found = left[near]
                ones.append(np.full(len(found), one))
                others.append(found)
                frontier.extend(found)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(ones), np.concatenate(others)) if ones else (none, none)


def link_groups(max_bits: int, keys: int, most: int | None):
    """Tasks that read rows sorted by their first ``keys`` columns, the fingerprint last, and give
    (a, b, slot, variant): links have a null slot; members of groups larger than ``most`` come back
    with b null, to be indexed again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        crowded = None  # the key of a group that is too large, while its rows still come
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in (*range(keys), batch.num_columns - 1)]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows, strict=True)]
            held, crowded, out = _settle(rows, crowded, False)
            yield from out
        if held is not None and len(held[0]):
            yield from _settle(held, crowded, True)[2]

    def _settle(rows: list[np.ndarray], crowded, last: bool):
        n = len(rows[0])
        change = np.zeros(n, bool)
        change[0] = True
        for key in rows[:-1]:
            change[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], n)
        fps = rows[-1].view(np.uint64)
        out, links_a, links_b = [], [], []

        def overflow(a: int, b: int) -> None:
            out.append(_links(fps[a:b], None, rows[0][a:b], rows[1][a:b]))

        if crowded is not None:
            if tuple(key[0] for key in rows[:-1]) == crowded:
                overflow(0, int(ends[0]))
                if len(starts) == 1 and not last:
                    return [r[n:] for r in rows], crowded, out
                starts, ends = starts[1:], ends[1:]
            crowded = None
        if not last and len(starts):
            keep = int(starts[-1])
            if most is not None and n - keep > most:
                overflow(keep, n)
                crowded, held = tuple(key[keep] for key in rows[:-1]), [r[n:] for r in rows]
            else:
                held = [r[keep:] for r in rows]
            starts, ends = starts[:-1], ends[:-1]
        else:
            held = [r[n:] for r in rows]
        sizes = ends - starts
        pairs = starts[sizes == 2]  # by far the most frequent
        near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= max_bits if len(pairs) else np.zeros(0, bool)
        links_a.append(fps[pairs][near])
        links_b.append(fps[pairs + 1][near])
        for a, b in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist(), strict=True):
            if most is not None and b - a > most:
                overflow(a, b)
                continue
            one, other = forest(fps[a:b], max_bits)
            links_a.append(one)
            links_b.append(other)
        out.append(_links(np.concatenate(links_a), np.concatenate(links_b), None, None))
        return held, crowded, out

    def _links(a, b, slot, variant) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a.view(np.int64)),
                pa.nulls(n, pa.int64()) if b is None else pa.array(b.view(np.int64)),
                pa.nulls(n, pa.int32()) if slot is None else pa.array(slot.astype(np.int32)),
                pa.nulls(n, pa.int64()) if variant is None else pa.array(variant),
            ],
            names=["a", "b", "slot", "variant"],
        )

    return run


LINKS = "a long, b long, slot int, variant long"


def near_links(fps: DataFrame, max_bits: int, most: int = GROUP_MOST) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints of ``fps`` (column fp, long) which steps of at
    most ``max_bits`` bits connect. Every link is within ``max_bits``."""
    indexed = fps.select("fp").mapInArrow(index_rows(max_bits), "slot int, variant long, fp long")
    sorted_rows = indexed.repartition(_partitions(fps), "slot", "variant").sortWithinPartitions(
        "slot", "variant"
    )
    found = materialize(sorted_rows.mapInArrow(link_groups(max_bits, 2, most), LINKS), "simhash-links")
    crowd = found.where("slot is not null").selectExpr("slot", "variant", "a as fp")
    fine = crowd.mapInArrow(
        refine_rows(max_bits), "slot int, variant long, slot2 int, variant2 long, fp long"
    )
    keys = ["slot", "variant", "slot2", "variant2"]
    fine = fine.repartition(_partitions(fps), *keys).sortWithinPartitions(*keys)
    more = fine.mapInArrow(link_groups(max_bits, 4, None), LINKS)
    return found.where("slot is null").select("a", "b").union(more.select("a", "b"))


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _labelled(df: DataFrame, id_col: str, text_col: str, words: int, max_bits: int, seed: int):
    """Stored (k1, k2, id, fp) of every row, and (class, component, component_low) of every fingerprint."""
    k1, k2 = row_key(id_col, text_col)
    rows = df.select(
        k1.alias("k1"),
        k2.alias("k2"),
        column(id_col).alias("id"),
        simhash(text_of(text_col), words, seed).alias("fp"),
    )
    rows = materialize(rows, "simhash-prints")
    # One row for each distinct fingerprint: the grouping has a map-side partial
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-classes")
    parts = connected_components(near_links(classes, max_bits), "simhash")
    labelled = classes.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component")
    )
    lows = labelled.groupBy("component").agg(F.min("low").alias("component_low"))
    least = labelled.join(lows, "component").select(F.col("fp").alias("class"), "component", "component_low")
    return rows, materialize(least, "simhash-least")


def near_duplicates(
    df: DataFrame, id_col: str, text_col: str, words: int = 3, max_bits: int = 3, seed: int = 42
) -> DataFrame:
    """The id column, fingerprint (16 hex digits) and component_id of every row: the least id that
    links of at most ``max_bits`` bits reach.

    Null and empty texts have fingerprint zero and link like any other. Null ids get a component, but
    count for none; a component of null ids only is null. Repeated rows link with each other. Other
    columns play no part; an empty table gives an empty result.
    """
    rows, least = _labelled(df, id_col, text_col, words, max_bits, seed)
    return rows.join(least, F.col("fp") == F.col("class")).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component_low").alias("component_id"),
    )


def keep_one(
    df: DataFrame, id_col: str, text_col: str, words: int = 3, max_bits: int = 3, seed: int = 42
) -> DataFrame:
    """``df`` without near-duplicates: of each component one row with the least id stays, and all rows
    of a component that has null ids only. Columns stay as they are."""
    rows, least = _labelled(df, id_col, text_col, words, max_bits, seed)
    k1, k2, one, other = fresh(df, "k1", "k2", "one", "other")
    placed = rows.join(least, F.col("fp") == F.col("class"))
    chosen = (
        placed.where(F.col("id") == F.col("component_low"))
        .groupBy("component")  # two components may share a repeated id
        .agg(F.min(F.struct("k1", "k2")).alias("key"))
        .select(F.col("key.k1").alias(k1), F.col("key.k2").alias(k2), F.lit(False).alias(other))
    )
    nameless = placed.where("component_low is null").select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.lit(True).alias(other)
    ).distinct()
    stay = materialize(chosen.union(nameless), "simhash-stay")
    keys = row_key(id_col, text_col)
    kept = df.withColumns({k1: keys[0], k2: keys[1]}).join(stay, [k1, k2])
    # Equal rows share a key; where ids are known, one of them stays
    turn = F.when(F.col(other), F.monotonically_increasing_id())
    return kept.withColumn(one, turn).dropDuplicates([k1, k2, one]).drop(k1, k2, one, other)
