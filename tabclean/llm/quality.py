"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one for each word and pair of neighbouring words, and
one for each character n-gram, all looked up in a table by hash. A linear layer and a softmax over
the two classes give the score. Table and layer are trained together by plain stochastic gradient
descent in numpy.

Training reads a bounded sample of the labelled rows (``SAMPLE_DOCS``), the rows with the least
seeded hash of their id, whole texts, each as counts of at most ``BUCKETS`` features. The trained
table times the layer is one number per bucket, so scoring needs a lookup and a mean per feature;
only these 2**18 numbers are broadcast, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column
from .common import flat, span_groups, text_of

BUCKETS = 1 << 18
DIM = 16
NGRAMS = (3, 4)
SAMPLE_DOCS = 3000
EPOCHS = 5
RATE = 0.5
BATCH = 16
PART = 1 << 18  # bytes of text featurised at once

MULT = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(64 - 18)


def _hashed(values: np.ndarray, salt: int) -> np.ndarray:
    """Bucket numbers of 64-bit values."""
    mixed = (values ^ np.uint64(salt)) * MULT
    mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
    return (mixed >> SHIFT).astype(np.int32)


def features(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For texts ``data[ends[i]:ends[i+1]]``: arrays of (bucket, text number), every feature once for
    each occurrence. Features never cross texts.

    Words are runs of bytes above the space character; letters keep their case, which tells shouting
    from prose. A word that equals the one before counts as a pair feature of its own.
    """
    if not len(data):
        return
    owner = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
    wide = data.astype(np.uint64)
    # n-grams of bytes, spaces and line ends included
    for n in NGRAMS:
        count = len(data) - n + 1
        if count <= 0:
            continue
        value = np.zeros(count, np.uint64)
        for i in range(n):
            value |= wide[i : i + count] << np.uint64(8 * i)
        inside = owner[:count] == owner[n - 1 :]
        yield _hashed(value[inside], n), owner[:count][inside]
    # words
    solid = data > 32
    edge = np.empty(len(data), bool)
    edge[0] = True
    edge[1:] = owner[1:] != owner[:-1]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = solid[:-1]
    first = np.flatnonzero(solid & (edge | ~before))
    if not len(first):
        return
    power = np.cumprod(np.full(len(data), MULT, np.uint64)[: min(len(data), 1 << 12)])
    # hash of a word: sum of byte times a power of its place in the word
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))) if first[0] == 0 else None
    if place is None:
        place = np.arange(len(data))
        place[first[0] :] -= np.repeat(first, np.diff(np.append(first, len(data))))
    weighted = np.where(solid, (wide + np.uint64(1)) * power[place & 4095], np.uint64(0))
    words = np.add.reduceat(weighted, first)
    of = owner[first]
    yield _hashed(words, 101), of
    if len(words) > 1:
        together = of[1:] == of[:-1]
        pair = np.where(words[1:] == words[:-1], np.uint64(7), words[1:] * MIX + words[:-1])
        yield _hashed(pair[together], 102), of[1:][together]


def long_features(data: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets of one text of any length, ``PART`` bytes at a time: the same as those of
    :func:`features`, since n-grams reach back over the border and an open word is carried over it."""
    power = np.cumprod(np.full(1 << 12, MULT, np.uint64))
    word, length, last = None, 0, None  # hash and length of the open word, hash of the word before
    for start in range(0, len(data), PART):
        part = data[start : start + PART]
        for n in NGRAMS:
            wide = data[max(0, start - n + 1) : start + PART].astype(np.uint64)
            count = len(wide) - n + 1
            if count > 0:
                value = np.zeros(count, np.uint64)
                for i in range(n):
                    value |= wide[i : i + count] << np.uint64(8 * i)
                yield _hashed(value, n)
        solid = part > 32
        weight = part.astype(np.uint64) + np.uint64(1)
        lead = 0
        if word is not None:
            lead = len(part) if solid.all() else int(solid.argmin())
            word = word + (weight[:lead] * power[(length + np.arange(lead)) & 4095]).sum(dtype=np.uint64)
            length += lead
        done = [] if last is None else [np.array([last], np.uint64)]
        if word is not None and lead < len(part):
            done.append(word)
            word = None
        before = np.zeros(len(part), bool)
        before[1:] = solid[:-1]
        first = np.flatnonzero(solid & ~before)
        first = first[first >= lead] if lead else first
        if len(first):
            place = np.arange(len(part))
            place[first[0] :] -= np.repeat(first, np.diff(np.append(first, len(part))))
            found = np.add.reduceat(np.where(solid, weight * power[place & 4095], np.uint64(0)), first)
            if solid[-1]:
                word, length, found = found[-1:], len(part) - int(first[-1]), found[:-1]
            done.append(found)
        if word is not None and start + PART >= len(data):
            done.append(word)
        words = np.concatenate(done) if done else np.zeros(0, np.uint64)
        yield _hashed(words if last is None else words[1:], 101)
        if len(words):
            pair = np.where(words[1:] == words[:-1], np.uint64(7), words[1:] * MIX + words[:-1])
            yield _hashed(pair, 102)
            last = words[-1]


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one whole text and how often each occurs. Memory does not follow its length."""
    parts, waiting = [], 0
    for buckets in long_features(np.frombuffer(text, np.uint8)):
        parts.append(_summed([(buckets, np.ones(len(buckets), np.int64))]))
        waiting += len(parts[-1][0])
        if waiting > 4 * BUCKETS:
            parts = [_summed(parts)]
            waiting = len(parts[0][0])
    buckets, counts = _summed(parts)
    return buckets, counts.astype(np.float32)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    buckets, place = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in parts]), len(buckets))
    return buckets.astype(np.int32), counts.astype(np.int64)


@dataclass(frozen=True)
class Model:
    """One weight per bucket and a bias: the log-odds of class 1 are their mean plus the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each text. A text without features gets the bias alone."""
        n = len(ends) - 1
        total, count = np.zeros(n), np.zeros(n)
        for buckets, owner in features(data, ends):
            total += np.bincount(owner, self.weights[buckets], n)
            count += np.bincount(owner, minlength=n)
        return self.finish(total, count)

    def long_score(self, data: np.ndarray) -> float:
        """:meth:`scores` of one text, in memory that does not follow its length."""
        total, count = 0.0, 0
        for buckets in long_features(data):
            total += float(self.weights[buckets].sum(dtype=np.float64))
            count += len(buckets)
        return float(self.finish(np.array([total]), np.array([count]))[0])

    def finish(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + total / np.maximum(count, 1))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 0) -> Model:
    """Fit table and layer on (buckets, counts, label 0 or 1) by stochastic gradient descent.

    The softmax cross-entropy weighs both classes alike in total, mildly (square root), so that a
    rare class is learned. Without rows, or with one class only, the bias alone tells the share.
    """
    labels = np.array([label for *_, label in rows], np.int64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    sizes = np.bincount(labels, minlength=2)
    weight = np.sqrt(len(labels) / (2 * sizes))
    steps, done = EPOCHS * (-(-len(rows) // BATCH)), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            rate = RATE * (1 - done / steps)
            done += 1
            for i in order[at : at + BATCH]:
                buckets, counts, label = rows[i]
                if not len(buckets):
                    continue
                share_of = counts / counts.sum()
                vectors = table[buckets]
                mean = share_of @ vectors
                logits = mean @ layer + bias
                chance = np.exp(logits - logits.max())
                chance /= chance.sum()
                chance[label] -= 1
                step = np.float32(rate * weight[label]) * chance
                table[buckets] = vectors - share_of[:, None] * (layer @ step) * np.float32(len(buckets) ** 0.5)
                layer -= np.outer(mean, step)
                bias -= np.float32(0.1) * step
    odds = layer[:, 1] - layer[:, 0]
    return Model((table @ odds).astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE_DOCS,
    seed: int = 0,
) -> Model:
    """Train on at most ``sample`` labelled rows. Labels other than 0 and 1 and null ids are left out; of
    contradicting labels of an id the greater counts. Only the sample's features reach the driver."""
    known = labels.where(column(label_col).isin(0, 1) & column(id_col).isNotNull())
    known = known.groupBy(column(id_col).alias("id")).agg(F.max(column(label_col)).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample)

    @F.arrow_udf("struct<buckets: array<int>, counts: array<float>>")
    def featurise(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [counted((t.as_py() or "").encode()) for t in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.float32())),
                ],
                ["buckets", "counts"],
            )

    picked = docs.select(column(id_col).alias("id"), text_of(text_col).alias("text")).join(
        F.broadcast(chosen),  # at most ``sample`` rows
        "id",
    )
    one = picked.dropDuplicates(["id"])  # a repeated id counts once
    found = one.select("id", "label", featurise("text").alias("f")).toArrow()
    rows = []
    for batch in found.to_batches():
        ids, known_labels, pairs = (batch.column(i) for i in range(3))
        lists = [pairs.field(0), pairs.field(1)]
        for i in range(len(batch)):
            buckets, counts = (f[i].values.to_numpy() for f in lists)
            rows.append((ids[i].as_py(), buckets, counts, known_labels[i].as_py()))
    rows.sort(key=lambda row: row[0])
    return train([row[1:] for row in rows], seed)


def score(df: DataFrame, model: Model, text: Column) -> Column:
    """The score of each whole text, from 0 to 1; the text must not be null. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 1 MB, always

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for batch in batches:
            data, ends = flat(batch)
            out = np.empty(len(batch))
            for a, b in span_groups(np.diff(ends), PART):
                if b - a > 1 or ends[b] - ends[a] <= PART:
                    out[a:b] = own.scores(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                else:
                    out[a] = own.long_score(data[ends[a] : ends[b]])
            yield pa.array(out)

    return run(text)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
) -> DataFrame:
    """The id column, held_out, score and predicted of every row.

    An id is held out if crc32 of its decimal text modulo ``folds`` is 0; labels of such ids are never
    learned from. Null ids are not held out. Null texts are scored as empty, repeated rows alike. An
    empty table gives an empty result; without labels the score is the same for all.
    """
    held = _held_out(id_col, folds)
    model = fit(docs, labels.where(~held), id_col, text_col, label_col)
    value = score(docs, model, text_of(text_col))
    return docs.select(
        column(id_col), F.coalesce(held, F.lit(False)).alias("held_out"), value.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; the columns stay."""
    model = fit(docs, labels.where(~_held_out(id_col, 5)), id_col, text_col)
    return docs.where(score(docs, model, text_of(text_col)) >= threshold)


def _held_out(id_col: str, folds: int) -> Column:
    return F.crc32(F.encode(column(id_col).cast("string"), "utf-8")) % folds == 0
