"""Merkle manifest of a dataset by time-forward processing.

The nodes of a tree are computed in the order of their labels, and every node sends its digest forward
to its parent, as a message that waits until the parent's turn comes. A second sweep goes through the
labels backwards: each node sends its children the digests they need to prove that they belong to
the root, and what reaches the leaves are whole proofs.

Messages wait in a priority queue ordered by label. Between tasks, Spark's spilling sort is this queue:
a block of ``fanout ** span`` consecutive nodes and what is sent to it meet in one task, in the order
of labels, and the digest of the block's top is sent on to the next round of blocks. Inside a block it is a
heap. Labels are in post order there, so a few messages a level wait at a time going forward.

No task sees more than one block at a time, however large a tree; a tree of n leaves takes
log(n) / log(fanout ** span) rounds. Only one number a round and the root reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize

SHIFT = 33  # monotonically_increasing_id has the partition above this bit
Pairs = list[str]  # digests left and right of a node, then of its parent, and so on: l, r, l, r, ...


@dataclass(frozen=True)
class Shape:
    fanout: int
    span: int  # levels that one task climbs

    def block(self) -> Column:
        """The block of the node at ``idx``."""
        return F.floor(F.col("idx") / self.fanout**self.span)

    def levels(self, n: int) -> int:
        """Levels above ``n`` nodes up to a single one."""
        out = 0
        while n > 1:
            n, out = -(-n // self.fanout), out + 1
        return out

    def climbed(self, n: int) -> int:
        return min(self.span, self.levels(n))


def leaf_digest(fields: list[str], shown: Mapping[str, Column] | None = None) -> Column:
    """SHA-256 of a row as lower-case hex: for each field ``-`` if null, else bytes, ``:`` and value."""
    parts = []
    for name in fields:
        value = (shown or {}).get(name, column(name)).cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def merkle_manifest(
    df: DataFrame,
    id_col: str,
    group_col: str,
    fields: list[str],
    found: Mapping[str, Column] | None = None,
    fanout: int = 8,
    span: int = 4,
) -> DataFrame:
    """Root and proofs of a table: a row for each row of ``df``.

    Every row is a leaf. The leaves of a group, in the order of ``id_col``, form a tree: as long as there are several
    nodes, every ``fanout`` consecutive ones, and what is left over, become one. The tops, in the
    order of the groups' names (null first, then by UTF-8 bytes), form one more tree up to the root.

    ``found`` says what is there of a field when the proofs are checked (as is: ``df`` itself).
    Columns: the id, ``leaf``, ``subroot``, ``root``, ``proof`` (digests left and right of the leaf,
    then of its parent, and so on), ``proof_sha256`` (of all of them, concatenated), ``folded_root``
    (the root that follows from the row as found and its proof) and ``verified``.

    Null ids come first; rows that share an id are ordered by their digests, and rows equal in all
    fields take neighbouring places of their own. Null fields and groups are values like any other. A lone leaf is
    its own root, with an empty proof. An empty table gives an empty result.

    ``span`` is how many levels a task climbs at once; it changes the work, not the result.
    """
    if fanout < 2 or span < 1:
        raise ValueError("fanout must be at least 2 and span at least 1")
    shape = Shape(fanout, span)
    kind = df.schema[id_col].dataType.simpleString()
    name = column(group_col).cast("string")
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),  # the null group sorts first
        column(id_col).alias("id"),
        leaf_digest(fields).alias("digest"),
        leaf_digest(fields, found).alias("found"),
    )
    leaves = _placed(materialize(rows, "merkle-leaves"), ["tree"], ["id", "digest"])
    levels = [materialize(leaves, "merkle-level")]
    tops = _climb(levels, shape)
    tops = tops.withColumnRenamed("tree", "name").withColumn("tree", F.lit(""))
    tops = materialize(_placed(tops, ["tree"], ["name"]), "merkle-tops")
    upper = [tops]
    root = [r["digest"] for r in _climb(upper, shape).collect()]  # one row, none for an empty table

    sent = F.array().cast("array<string>")
    first = tops.select("tree", F.lit(0).cast("long").alias("block"), sent.alias("pairs"), F.lit("").alias("subroot"))
    pairs = _descend(upper, first.limit(1), shape)
    pairs = pairs.join(tops.select("tree", "idx", "name", "digest"), ["tree", "idx"]).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "pairs", F.col("digest").alias("subroot")
    )
    for level in levels[:0:-1]:
        pairs = _descend_once(level, pairs, shape)
    return _proofs(levels[0], pairs, id_col, kind, root[0] if root else "", shape)


def _placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``idx``, the place from 0 in the group, and ``n``, the group's rows.

    Rows are sorted by ranges, so a group of any size spreads; ranges are counted, not gathered.
    Rows that are equal throughout are told apart by where they are read, so that they spread too.
    """
    keys = [*group, *order]
    apart = df.withColumn("at", F.monotonically_increasing_id())
    placed = apart.repartitionByRange(*keys, "at").sortWithinPartitions(*keys, "at")
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("at", SHIFT)
    counts = placed.groupBy(*group, part.alias("part")).agg(
        F.min("at").alias("head"), F.count(F.lit(1)).alias("rows")
    )
    ranges = Window.partitionBy(*group)  # as many rows as ranges with this group
    counts = counts.withColumns(
        {"n": F.sum("rows").over(ranges), "before": F.sum("rows").over(ranges.orderBy("part"))}
    )
    counts = counts.select(*group, "part", "n", (F.col("before") - F.col("rows") - F.col("head")).alias("shift"))
    placed = placed.withColumn("part", part).join(counts, [*group, "part"])
    return placed.withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _climb(levels: list[DataFrame], shape: Shape) -> DataFrame:
    """(tree, digest) of every tree's top; appends the nodes of each round to ``levels``."""
    tops = []
    while True:
        nodes = levels[-1]
        tops.append(nodes.where("n = 1").select("tree", "digest"))
        if not (nodes.agg(F.max("n")).first()[0] or 0) > 1:
            out = tops[0]
            for some in tops[1:]:
                out = out.unionByName(some)
            return out
        rows = nodes.where("n > 1").select("tree", shape.block().alias("block"), "idx", "n", "digest")
        rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        up = rows.mapInArrow(_forward(shape), "tree string, idx long, n long, digest string")
        levels.append(materialize(up, "merkle-level"))


def _descend(levels: list[DataFrame], pairs: DataFrame, shape: Shape) -> DataFrame:
    for level in reversed(levels):
        pairs = _descend_once(level, pairs, shape)
    return pairs.withColumnRenamed("block", "idx")


def _descend_once(nodes: DataFrame, pairs: DataFrame, shape: Shape) -> DataFrame:
    """(tree, block, pairs, subroot): for each node the block below it and what it needs for a proof.

    ``pairs`` has the same for the blocks of ``nodes``. Trees that were done in an earlier round
    are not among ``nodes``; what is sent to them passes by.
    """
    rows = _messages(nodes, pairs, shape)
    down = rows.mapInArrow(_backward(shape), "tree string, block long, pairs array<string>, subroot string")
    return materialize(down, "merkle-proofs")


def _messages(nodes: DataFrame, pairs: DataFrame, shape: Shape, *more: str) -> DataFrame:
    """Nodes by block, each block's message ahead of them."""
    some = nodes.select("tree", shape.block().alias("block"), "idx", "n", "digest", *more)
    sent = pairs.withColumn("idx", F.lit(-1).cast("long"))
    rows = some.unionByName(sent, allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def sweep(digests: list[str], fanout: int, levels: int) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """The node ``levels`` above a block, and (last leaf, level, children's digests) of all nodes.

    Nodes come in post order, which is the order of (last leaf below them, level).
    """
    last = len(digests) - 1
    queue: list[tuple[int, int, int, str]] = []  # (the receiver's last leaf and level, child, digest)
    nodes = []
    top = digests[0]

    def send(at: int, level: int, digest: str) -> None:
        span = fanout**level
        heappush(queue, (min(at - at % span + span - 1, last), level, at, digest))

    for at, digest in enumerate(digests):
        if levels:
            send(at, 1, digest)
        while queue and queue[0][0] <= at:
            end, level = queue[0][:2]
            children = []
            while queue and queue[0][:2] == (end, level):
                children.append(heappop(queue)[3])
            top = _sha("".join(children))
            nodes.append((end, level, children))
            if level < levels:
                send(at, level + 1, top)
    return top, nodes


def sweep_back(nodes: list[tuple[int, int, list[str]]], leaves: int, fanout: int, pairs: Pairs) -> list[Pairs]:
    """What each leaf of a block needs for its proof, given what the block's top needs."""
    out = [pairs] * leaves
    queue: list[tuple[int, int, Pairs]] = []  # (the receiver's last leaf and level, negated, pairs)
    if nodes:
        heappush(queue, (-nodes[-1][0], -nodes[-1][1], pairs))
    for end, level, children in reversed(nodes):
        label = heappop(queue)
        if label[:2] != (-end, -level):
            raise AssertionError("a message missed its node")
        span = fanout ** (level - 1)
        start = end - end % (span * fanout)
        for i in reversed(range(len(children))):
            mine = ["".join(children[:i]), "".join(children[i + 1 :]), *label[2]]
            child = min(start + (i + 1) * span - 1, end)
            if level == 1:
                out[child] = mine
            else:
                heappush(queue, (-child, -(level - 1), mine))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == most:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def _forward(shape: Shape):
    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            found = list(rows)
            n = found[0][3]
            levels = shape.climbed(n)
            top, _ = sweep([r[4] for r in found], shape.fanout, levels)
            yield tree, block, -(-n // shape.fanout**levels), top

    return lambda batches: _batches(up(batches), schema)


def _swept(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[tuple[tuple, Pairs, str]]:
    """(node, what it needs for its proof, its tree's top) for all nodes; messages that meet no node too."""
    for _, rows in groupby(_rows(batches), key=lambda r: r[:2]):
        message, *nodes = rows
        *_, pairs, subroot = message
        if not nodes:
            yield message, pairs, subroot
            continue
        levels = shape.climbed(nodes[0][3])
        _, inner = sweep([r[4] for r in nodes], shape.fanout, levels)
        yield from (
            (node, mine, subroot)
            for node, mine in zip(nodes, sweep_back(inner, len(nodes), shape.fanout, pairs), strict=True)
        )


def _backward(shape: Shape):
    schema = pa.schema(
        [("tree", pa.string()), ("block", pa.int64()), ("pairs", pa.list_(pa.string())), ("subroot", pa.string())]
    )

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for node, pairs, subroot in _swept(batches, shape):
            yield node[0], node[1] if node[2] < 0 else node[2], pairs, subroot

    return lambda batches: _batches(down(batches), schema)


def fold(digest: str, pairs: Pairs) -> str:
    """The root that follows from a leaf and its proof."""
    for i in range(0, len(pairs), 2):
        digest = _sha(pairs[i] + digest + pairs[i + 1])
    return digest


def _proofs(
    leaves: DataFrame, pairs: DataFrame, id_col: str, kind: str, root: str, shape: Shape
) -> DataFrame:
    rows = _messages(leaves, pairs, shape, "id", "found")
    rows = rows.select("tree", "block", "idx", "n", "digest", "id", "found", "pairs", "subroot")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.string()
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema(
            [
                pa.field("id", first.schema.field("id").type),
                *[pa.field(c, text) for c in ("leaf", "subroot", "root")],
                pa.field("proof", pa.list_(text)),
                *[pa.field(c, text) for c in ("proof_sha256", "folded_root")],
                pa.field("verified", pa.bool_()),
            ]
        )

        def rows() -> Iterator[tuple]:
            yield from (first,)
            yield from batches

        def proved() -> Iterator[tuple]:
            for node, mine, subroot in _swept(rows(), shape):
                folded = fold(node[6], mine)
                yield node[5], node[4], subroot, root, mine, _sha("".join(mine)), folded, folded == root

        yield from _batches(proved(), schema)

    out = rows.mapInArrow(
        prove,
        f"id {kind}, leaf string, subroot string, root string, proof array<string>, "
        "proof_sha256 string, folded_root string, verified boolean",
    )
    return out.withColumnRenamed("id", id_col)
