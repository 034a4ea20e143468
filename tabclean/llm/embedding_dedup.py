"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are spread over a bounded sample, each the farthest from those before it,
until none is left that is farther than ``APART`` from all; so a dense group has few of them. A vector
is described by its ``NEAR`` nearest pivots in order. It is posted in the inverted lists of the first
``POSTS`` of them and looks for partners in the lists of all.

A pair that meets in a list is judged if the two descriptions share at least ``SHARED`` pivots, which
is counted list by list, or have the same nearest pivot. The second rule is the exact way for crowds:
where many vectors lie around one pivot, the rest of their orders is noise, and all pairs inside that
crowd are judged, each once. Judged pairs are verified by their cosine in double precision.

The lists of a label are put together into groups of about ``BLOCK`` postings; a longer list is cut by
a hash of the entries. A task holds the postings of one group and streams past them the vectors that
look there, so its memory is bounded, however crowded a list is. A vector travels to each group once
to look, to at most ``NEAR`` of them while no list is longer than ``BLOCK``, and at most ``POSTS``
times to be posted.

Equal vectors are one entry with a weight. A task returns per entry a number of links and a root, never
the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize
from .components import connected_components

PIVOTS = 512
SAMPLE = 4  # vectors looked at for each pivot
APART = 0.8  # cosine above which a vector needs no pivot beside the one it has
NEAR = 16
POSTS = 3
SHARED = 3
BLOCK = 16384
STRIPE = 256
SLACK = 1e-6  # more than the rounding of angles


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` of the unit vectors, each the farthest from those before it and farther from
    them than ``APART``."""
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)) and nearest.min() <= APART:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def units(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision and safe from overflow."""
    wide = raw.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of each (label, size), the first two columns."""
    label, size = (batch.column(i).to_numpy() for i in (0, 1))
    order = np.lexsort((size, label))
    new = (np.diff(label[order]) != 0) | (np.diff(size[order]) != 0)
    for mine in np.split(order, np.flatnonzero(new) + 1):
        if len(mine):
            yield batch.take(pa.array(mine))


def _describe(sample: dict[int, np.ndarray]):
    """Tasks that add to (label, size, node, weight, raw) the nearest pivots, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                size = part.column(1)[0].as_py()
                near = np.zeros((len(part), 1), np.int16)  # a size that the sample lacks: one list
                if size in sample:
                    likeness = units(_matrix(part.column(4), size)) @ sample[size].T
                    near = np.argsort(-likeness, axis=1, kind="stable")[:, :NEAR].astype(np.int16)
                ends = np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(5)), lists],
                    names=["label", "size", "node", "weight", "raw", "near"],
                )

    return run


def group_lists(posted: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each list, from how many vectors are posted in it.

    Lists share a group while it holds at most ``block``; a longer list has groups of its own.
    """
    first, count = np.zeros(len(posted), np.int64), -(-posted // block)
    group, held = 0, 0
    for i, n in enumerate(posted.tolist()):
        if held and held + n > block:
            group, held = group + 1, 0
        first[i] = group
        held += n
        if count[i] > 1:
            group, held = group + int(count[i]), 0
    return first, count


def _deal(block: int):
    """Tasks that turn (label, size, node, weight, raw, near, lists) into rows of groups.

    ``lists`` tells of the label how many vectors are posted with each pivot. ``posts`` has a bit for
    each of the first pivots with which the row is posted in the group; 0 looks for partners.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                lists = sorted(part.column(6)[0].as_py(), key=lambda c: c["pivot"])
                pivot, posted = (np.array([c[k] for c in lists], np.int64) for k in ("pivot", "posted"))
                first, count = group_lists(posted, block)
                step = max(1, (1 << 16) // int(NEAR + count.sum()))
                for at in range(0, len(part), step):
                    yield from rows(part.slice(at, step), pivot, first, count)

    def rows(part, pivot, first, count) -> Iterator[pa.RecordBatch]:
        near = _near(part.column(5))
        at = np.minimum(np.searchsorted(pivot, near), len(pivot) - 1)
        known = pivot[at] == near  # nothing is posted with the other pivots
        mixed = part.column(2).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed >>= np.uint64(32)
        row, rank = np.nonzero(known)
        begin, times = first[at[row, rank]], count[at[row, rank]]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        looks = np.unique(np.stack([np.repeat(row, times), np.repeat(begin, times) + step]), axis=1)
        here = rank < POSTS
        row, rank, begin, times = row[here], rank[here], begin[here], times[here]
        begin = begin + (mixed[row] % times.astype(np.uint64)).astype(np.int64)
        places, inverse = np.unique(np.stack([row, begin]), axis=1, return_inverse=True)
        bits = np.bincount(inverse.ravel(), (1 << rank).astype(float), places.shape[1])
        of = np.concatenate([places[0], looks[0]])
        group = np.concatenate([places[1], looks[1]])
        posts = np.concatenate([bits.astype(np.int32), np.zeros(looks.shape[1], np.int32)])
        short = pa.array([r.tobytes() for r in near.astype("<i2")], pa.binary())
        for a in range(0, len(of), 1 << 14):
            mine = pa.array(of[a : a + (1 << 14)])
            spread = part.take(mine)
            found = posts[a : a + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [
                    spread.column(0),
                    spread.column(1),
                    pa.array(group[a : a + (1 << 14)]),
                    pa.array(found == 0),
                    pa.array(found),
                    *(spread.column(i) for i in (2, 3, 4)),
                    short.take(mine),
                ],
                names=["label", "size", "group", "looks", "posts", "node", "weight", "raw", "near"],
            )

    return run


def _near(column_: pa.Array) -> np.ndarray:
    """Rows of pivots from lists of equal length."""
    return column_.flatten().to_numpy(zero_copy_only=False).reshape(len(column_), -1)


def _matrix(column_: pa.Array, size: int) -> np.ndarray:
    """Rows of doubles from binary values that hold ``size`` floats or doubles each."""
    values = [v.as_py() for v in column_]
    kinds = {len(v) for v in values}
    if len(kinds) == 1:
        kind = "<f4" if kinds == {4 * size} else "<f8"
        return np.frombuffer(b"".join(values), kind).reshape(-1, size).astype(np.float64)
    return np.array([np.frombuffer(v, "<f4" if len(v) == 4 * size else "<f8") for v in values], np.float64)


class _Postings:
    """What is posted in the lists of a group, with the links found so far."""

    def __init__(self, rows: pa.RecordBatch, threshold: float):
        self.threshold = threshold
        self.size = rows.column(1)[0].as_py()
        near = np.frombuffer(b"".join(v.as_py() for v in rows.column(8)), "<i2").reshape(len(rows), -1)
        order = np.argsort(near[:, 0], kind="stable")
        self.near = near[order]
        posts, self.node, self.weight = (rows.column(i).to_numpy()[order] for i in (4, 5, 6))
        self.here = (posts[:, None] >> np.arange(POSTS)) & 1 == 1
        self.vectors = units(_matrix(rows.column(7), self.size))[order]
        self.need = min(SHARED, self.near.shape[1])
        self.links = np.zeros(len(order), np.int64)
        self.root = np.arange(len(order))
        # The inverted lists: who has a pivot anywhere in the description
        flat = self.near.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.pivots, starts = np.unique(flat[by_pivot], return_index=True)
        members = np.split(by_pivot // self.near.shape[1], starts[1:])
        self.lists = dict(zip(self.pivots.tolist(), members, strict=True))
        # Those whose nearest pivot is posted here, by that pivot; and all by their nearest pivot
        self.homes = np.flatnonzero(self.here[:, 0])
        self.home_pivots = self.near[self.homes, 0]
        nearest, begin, count = np.unique(self.near[:, 0], return_index=True, return_counts=True)
        large = np.flatnonzero(count * 8 > len(order))  # fewer than eight
        self.crowds = [(int(nearest[i]), int(begin[i]), int(begin[i] + count[i])) for i in large]

    def look(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The links of the rows that look for partners: (node, links, root)."""
        node, weight = (rows.column(i).to_numpy() for i in (5, 6))
        near = np.frombuffer(b"".join(v.as_py() for v in rows.column(8)), "<i2").reshape(len(rows), -1)
        vectors = units(_matrix(rows.column(7), self.size))
        links, base = np.zeros(len(rows), np.int64), len(self.node)
        root = np.concatenate([self.root, base + np.arange(len(rows))])
        for a, b in self._verified(near, node, vectors):
            np.add.at(links, b, self.weight[a])
            np.add.at(self.links, a, weight[b])
            _join(root, a, base + b)
        self.root = root[:base]  # every link has a posted end, and roots are least places
        found = np.flatnonzero(links)
        if len(found):
            yield _found(node[found], links[found], self.node[root[base + found]])

    def rest(self) -> Iterator[pa.RecordBatch]:
        found = np.flatnonzero(self.links)
        if len(found):
            yield _found(self.node[found], self.links[found], self.node[self.root[found]])

    def _verified(self, near, node, vectors) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links (posted, looking) that belong to this group."""
        nearest = near[:, 0]
        for pivot in np.unique(nearest).tolist():
            a, b = np.searchsorted(self.home_pivots, [pivot, pivot + 1])
            if a == b:
                continue
            mine, homes = np.flatnonzero(nearest == pivot), self.homes[a:b]
            for at in range(0, len(mine), STRIPE):
                some = mine[at : at + STRIPE]
                once = self.node[homes][None, :] < node[some][:, None]
                for i, j in self._close(vectors[some], homes, once):
                    yield homes[j], some[i]
        left = np.ones(len(near), bool)
        for pivot, a, b in self.crowds:
            mine = np.flatnonzero(nearest == pivot)
            left[mine] = False
            yield from self._shared(mine, near, node, vectors, a, b)
        yield from self._shared(np.flatnonzero(left), near, node, vectors, 0, 0)

    def _shared(self, mine, near, node, vectors, a, b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of rows ``mine`` with those of another nearest pivot and enough shared pivots; places
        from a to b have the same nearest pivot as all of the rows."""
        everyone = np.arange(len(self.node))
        for at in range(0, len(mine), STRIPE):
            some = mine[at : at + STRIPE]
            count = np.zeros((len(some), len(self.node)), np.uint8)
            flat = near[some].ravel()
            order = np.argsort(flat, kind="stable")
            pivots, starts = np.unique(flat[order], return_index=True)
            for pivot, rows in zip(pivots.tolist(), np.split(order // near.shape[1], starts[1:]), strict=True):
                posted = self.lists.get(pivot)
                if posted is None:
                    continue
                if b > a:
                    x, y = np.searchsorted(posted, [a, b])
                    posted = np.concatenate([posted[:x], posted[y:]])
                count[rows[:, None], posted] += 1
            enough = (count >= self.need) & (near[some, 0][:, None] != self.near[:, 0][None, :])
            for i, j in self._close(vectors[some], everyone, enough):
                mine_too = self._belongs(j, near[some[i]], node[some[i]])
                yield j[mine_too], some[i[mine_too]]

    def _belongs(self, a: np.ndarray, near: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Of all lists in which a pair meets, whether the first is here; where both are posted in it,
        the lesser entry counts as posted and the other as looking."""
        none = np.iinfo(np.int16).max
        posts_a, posts_b = self.near[a, :POSTS], near[:, :POSTS]
        met_a = (posts_a[:, :, None] == near[:, None, :]).any(axis=2)
        met_b = (posts_b[:, :, None] == self.near[a][:, None, :]).any(axis=2)
        first = np.minimum(np.where(met_a, posts_a, none).min(axis=1), np.where(met_b, posts_b, none).min(axis=1))
        here = (self.here[a][:, : posts_a.shape[1]] & (posts_a == first[:, None])).any(axis=1)
        return here & (~(posts_b == first[:, None]).any(axis=1) | (self.node[a] < node))

    def _close(self, vectors, places, judged) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, index into places) of the mask ``judged`` that reach the threshold."""
        wanted = int(judged.sum())
        if wanted * 16 > judged.size:
            close = vectors @ self.vectors[places].T
            i, j = np.nonzero(judged & (close >= self.threshold - SLACK))
            sure = close[i, j] >= self.threshold + SLACK
        else:
            i, j = np.nonzero(judged)
            sure = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            linked = sure[at : at + (1 << 14)].copy()
            edge = np.flatnonzero(~linked)
            exact = np.einsum("ij,ij->i", vectors[a[edge]], self.vectors[places[b[edge]]])
            linked[edge] = exact >= self.threshold
            if linked.any():
                yield a[linked], b[linked]


def _found(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(node), pa.array(links), pa.array(root)]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "links", "root"])


def _judge(threshold: float):
    """Tasks over rows sorted by label, size, group and looks: (node, links, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, postings = None, [], None
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            new = np.zeros(len(batch), bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            ends = [*np.flatnonzero(new).tolist(), len(batch)]
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                if a == b:
                    continue
                if (mine := tuple(k[a] for k in keys[:3])) != key:
                    if postings:
                        yield from postings.rest()
                    key, waiting, postings = mine, [], None
                rows = batch.slice(a, b - a)
                if not keys[3][a]:
                    waiting.append(rows)
                    continue
                if waiting:
                    posted = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    postings, waiting = _Postings(posted, threshold), []
                if postings:
                    yield from postings.look(rows)
        if postings:
            yield from postings.rest()

    return run


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let everything that ``a`` and ``b`` connect have one root, the least place."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    threshold: float = 0.93,
    pivots: int = PIVOTS,
) -> DataFrame:
    """The id column, n_links, component_id and kept of every row.

    Rows link if their labels are equal and not null, their vectors have the same number of
    components, and the cosine is at least ``threshold``; with ``label_col`` None labels play no part.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    n_links counts other rows linked directly; component_id is the least id that links reach;
    kept tells whether that is the row's own. No link is below the threshold. Links are those whose two
    vectors the index brings together: all with the same nearest pivot, others as a rule (see README for
    the recall against brute force, measured at 0.93).

    Null ids link but are never a component's id; a component of null ids has a null one and its rows
    are kept. Rows with repeated ids stay rows of their own. An empty table gives an empty result.
    ``pivots`` bounds the reference points; labels of many millions of vectors want more of them.
    """
    label = F.lit(0) if label_col is None else column(label_col)
    vector = column(vector_col).cast("array<double>")
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    text = F.when(usable, F.transform(vector, lambda x: x + F.lit(0.0)))  # -0.0 becomes 0.0
    rows = df.select(
        column(id_col).alias("id"),
        F.when(usable, label).alias("label"),
        text.alias("vector"),
        F.xxhash64(F.lit(1), text).alias("h1"),
        F.xxhash64(F.lit(2), text).alias("h2"),
    )
    key = ["label", "h1", "h2"]
    good = rows.where("vector is not null")
    entries = good.groupBy(*key).agg(
        F.count(F.lit(1)).alias("weight"), F.min("id").alias("low"), F.first("vector").alias("vector")
    )
    entries = entries.withColumns(
        {"node": F.monotonically_increasing_id(), "size": F.size("vector"), "list_label": F.xxhash64("label")}
    )
    entries = materialize(entries, "pivot-entries")
    place = ["label", "size"]
    raw = _as_binary(entries).select(*place, "node", "weight", "raw")
    sample = _sample(entries, pivots)
    described = materialize(
        raw.mapInArrow(
            _describe(sample), "label long, size int, node long, weight long, raw binary, near array<short>"
        ),
        "pivot-near",
    )
    posted = described.select(*place, F.explode(F.slice("near", 1, POSTS)).alias("pivot"))
    lists = posted.groupBy(*place, "pivot").agg(F.count(F.lit(1)).alias("posted"))
    lists = lists.groupBy(*place).agg(F.collect_list(F.struct("pivot", "posted")).alias("lists"))
    spread = described.join(materialize(lists, "pivot-lists"), place).select(
        *place, "node", "weight", "raw", "near", "lists"
    )
    keys = [*place, "group"]
    count = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tasks = spread.mapInArrow(
        _deal(BLOCK),
        "label long, size int, group long, looks boolean, posts int, node long, weight long, raw binary, near binary",
    )
    tasks = tasks.repartition(count, *keys).sortWithinPartitions(*keys, "looks")
    found = materialize(
        tasks.mapInArrow(_judge(threshold), "node long, links long, root long"), "pivot-links"
    )
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.selectExpr("node as a", "root as b"), "pivot")
    parts = entries.select("node", "low").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = parts.groupBy("component").agg(F.min("low").alias("component_id"))
    known = entries.select(*key, "node", "weight").join(parts.select("node", "component"), "node")
    known = known.join(least, "component").join(degree, "node", "left").select(
        *[F.col(k).alias(f"at_{k}") for k in key],
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id",
    )
    known = materialize(known, "pivot-known")
    joined = rows.join(known, [F.col(k) == F.col(f"at_{k}") for k in key], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def _as_binary(entries: DataFrame) -> DataFrame:
    """(node, label, size, raw, weight): vectors as little-endian floats where these are exact, else
    doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            values, ends = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            with np.errstate(over="ignore"):
                short = values.astype("<f4")
            exact = short == values
            raw = [
                short[a:b].tobytes() if exact[a:b].all() else values[a:b].astype("<f8").tobytes()
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(raw, pa.binary()), batch.column(4)],
                names=["node", "label", "size", "raw", "weight"],
            )

    rows = entries.select("node", F.col("list_label").alias("label"), "size", "vector", "weight")
    return rows.mapInArrow(run, "node long, label long, size int, raw binary, weight long")


def _sample(entries: DataFrame, count: int) -> dict[int, np.ndarray]:
    """At most ``count`` pivots by number of components, out of the ``SAMPLE`` times as many vectors with
    the least hash."""
    chosen = entries.orderBy("h1", "h2", "label").limit(SAMPLE * count)
    by_size: dict[int, list] = {}
    for row in _as_binary(chosen).select("size", "raw").collect():
        by_size.setdefault(row["size"], []).append(bytes(row["raw"]))
    return {
        size: spread_pivots(units(_matrix(pa.array(raw, pa.binary()), size)), count)
        for size, raw in by_size.items()
    }
