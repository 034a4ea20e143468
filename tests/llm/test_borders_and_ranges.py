"""Long texts are scored alike whole and in parts; neighbours of ids of any type."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclean.llm import quality
from tabclean.llm.multiset_hash import compare_with_next, edited_text, fingerprint, likeness, to_hex


def whole(data):
    return np.sort(np.concatenate([b for b, _ in quality.features(data, np.array([0, len(data)]))] or [[]]))


@pytest.mark.parametrize("part", [1, 2, 3, 5, 64, 1000])
def test_features_do_not_depend_on_parts(monkeypatch, part):
    picker = random.Random(part)
    texts = [b"", b" ", b"a", b"one  two two\n", b"x" * 9000 + b" y", "wörter und 日本語 ".encode() * 40]
    texts += [bytes(picker.choice(b"ab \n") for _ in range(picker.randrange(300))) for _ in range(40)]
    monkeypatch.setattr(quality, "PART", part)
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        found = np.sort(np.concatenate([*quality.long_features(data), np.zeros(0, np.int32)]))
        assert np.array_equal(found, whole(data)), text[:40]


def test_score_of_a_long_text_is_that_of_the_whole():
    picker = np.random.default_rng(1)
    model = quality.Model(picker.normal(size=quality.BUCKETS).astype(np.float32), 0.1)
    data = picker.choice(np.frombuffer(b"abcdefgh  \n", np.uint8), 1 << 20)
    assert model.long_score(data) == pytest.approx(model.scores(data, np.array([0, len(data)]))[0], abs=1e-9)


def check(spark, rows, kind, order):
    """Against the neighbours found in plain Python."""
    df = spark.createDataFrame(rows, f"id {kind}, text string")
    found = {r["id"]: r for r in compare_with_next(df.repartition(5), "id", "text").collect()}
    ordered = sorted(rows, key=order)
    assert len(found) == len(rows)
    for (id_, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        sums, edited = fingerprint(text), fingerprint(edited_text(text, following))
        row = found[id_]
        assert (row["n_chars"], row["fingerprint"], row["edited_fingerprint"]) == (len(text), to_hex(sums), to_hex(edited))
        assert row["near_edited"] == likeness(sums, edited)
        assert row["near_next"] == likeness(sums, fingerprint(following))


def texts(n):
    picker = random.Random(n)
    lines = ["one line here", "another", "a third line of words", ""]
    return [None if i == 3 else "\n".join(picker.choices(lines, k=picker.randrange(5))) for i in range(n)]


def test_neighbours_of_numbers_and_text(spark):
    body = texts(60)
    check(spark, [(i * 7 - 100, t) for i, t in enumerate(body)], "long", lambda r: -r[0])
    named = [(f"d{i:03}é" if i % 2 else f"D-{i:03}", t) for i, t in enumerate(body)]
    found = sorted(named, key=lambda r: r[0], reverse=True)
    check(spark, named, "string", lambda r: found.index(r))


def test_one_null_or_repeated_id_is_spread(spark):
    """Rows of one id are cut into ranges as well, by the hash of their text."""
    rows = [(None, f"text {i}") for i in range(200)] + [(5, f"more {i}") for i in range(200)] + [(5, "same")] * 3
    df = spark.createDataFrame(rows, "id long, text string")
    result = compare_with_next(df, "id", "text")
    assert result.count() == 403
    parts = [r["count"] for r in result.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(parts) == tasks and max(parts) < 2 * 403 / tasks
    kept = result.where("id is null").count()
    assert kept == 200
