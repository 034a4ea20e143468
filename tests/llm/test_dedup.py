"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tabclean.llm import embedding_dedup, simhash, suffix_dedup, superkmer_dedup, windows
from tabclean.llm.components import connected_components


def merged(spans):
    out = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def cut(units, window, times):
    spans = merged([(i, i + window) for i in range(len(units) - window + 1) if times[units[i : i + window]] > 1])
    keep, at = [], 0
    for a, b in spans:
        keep.append(units[at:a])
        at = b
    return [*keep, units[at:]], len(spans)


def expected_bytes(corpus, window=200):
    data = [(i, (t or "").encode()) for i, t in corpus]
    times = Counter(d[k : k + window] for _, d in data for k in range(len(d) - window + 1))
    out = []
    for i, d in data:
        keep, n = cut(d, window, times)
        kept = b"".join(keep)
        out.append((i, len(d), len(d) - len(kept), n, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def expected_words(corpus, window=35):
    data = [(i, tuple((t or "").encode().split())) for i, t in corpus]
    times = Counter(d[k : k + window] for _, d in data for k in range(len(d) - window + 1))
    out = []
    for i, d in data:
        kept = [w for part in cut(d, window, times)[0] for w in part]
        out.append((i, len(d), len(d) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [2, 4096])
def test_repeated_bytes(docs, corpus, monkeypatch, most):
    monkeypatch.setattr(windows, "GROUP_MOST", most)
    got = suffix_dedup.remove_repeats(docs, "doc_id", "text", keep_first=False, with_text=False)
    assert got.columns == ["doc_id", "source", "k1", "m", "fp", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, rows), key=str) == expected_bytes(corpus)


@pytest.mark.parametrize("most", [2, 4096])
def test_repeated_words(docs, corpus, monkeypatch, most):
    monkeypatch.setattr(windows, "GROUP_MOST", most)
    got = superkmer_dedup.remove_repeated_words(docs, "doc_id", "text")
    rows = got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, rows), key=str) == expected_words(corpus)


@pytest.mark.parametrize("most", [2, 4096])
def test_first_copy_stays(spark, passage, monkeypatch, most):
    monkeypatch.setattr(windows, "GROUP_MOST", most)
    shared = passage(3, 80)
    rows = [(i, f"{passage(100 + i, 30)} {shared} {passage(200 + i, 30)}") for i in range(8)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = suffix_dedup.remove_repeats(df, "id", "text", keep_first=True).orderBy("id").collect()
    assert got[0]["text"] == rows[0][1] and got[0]["n_removed"] == 0
    assert all(shared not in r["text"] and r["n_removed"] >= len(shared) for r in got[1:])


def test_nearest_smaller_and_ranks():
    values = np.array([5, 2, 8, 1, 9, 3])
    back, ahead = suffix_dedup.nearest_smaller(values, np.ones(5, bool))
    assert back.tolist() == [-1, -1, 1, -1, 3, 3] and ahead.tolist() == [1, 3, 3, -1, 5, -1]
    data = np.frombuffer(b"banana", np.uint8)
    ranks = suffix_dedup.prefix_ranks(data, 6)
    assert sorted(range(6), key=lambda i: b"banana"[i:]) == np.argsort(ranks).tolist()


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    sums = [sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) for bit in range(64)]
    return sum(1 << bit for bit in range(64) if 2 * sums[bit] > len(shingles))


def components(values, linked):
    part = list(range(len(values)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                part[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_simhash(docs, corpus, rows):
    prints = [fingerprint(t) for _, t in corpus]
    part = components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for (i, _), p in zip(corpus, part, strict=True):
        if i is not None:
            low[p] = min(i, low.get(p, i))
    want = sorted(
        ((i, f"{f:016x}", low.get(p)) for (i, _), f, p in zip(corpus, prints, part, strict=True)), key=str
    )
    assert sorted(rows(simhash.near_duplicates(docs, "doc_id", "text")), key=str) == want
    kept = simhash.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(low.values())


def test_simhash_crowded_groups(spark):
    """Groups beyond the limit are indexed again and lose no link."""
    random = np.random.default_rng(3)
    base = int(random.integers(1 << 62))
    near = {base ^ (1 << int(b)) ^ (1 << int(c)) for b, c in random.integers(0, 62, (150, 2))}
    far = {int(v) for v in random.integers(1 << 62, size=100)}
    values = sorted(near | far)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for most in (3, 4096):
        links = simhash.near_links(df, 3, most).collect()
        assert all((r["a"] ^ r["b"]).bit_count() <= 3 for r in links)
        found = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in links}
        via = components(values, lambda a, b: (min(a, b), max(a, b)) in found)  # noqa: B023
        assert via == components(values, lambda a, b: (a ^ b).bit_count() <= 3)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys([*range(41), 100], 0), 200: 200, 201: 200}


def vectors(spark):
    random = np.random.default_rng(5)
    rows, n = [], 0
    for group in range(60):
        center = random.standard_normal(32)
        for _ in range(4):
            rows.append((n, (center + 0.12 * random.standard_normal(32)).tolist(), group % 3))
            n += 1
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 1), (n + 2, None, 0), (n + 3, [0.0] * 32, 0)]
    rows += [(n + 4, [float("nan")] * 32, 0), (n + 5, [None, *[1.0] * 31], 0), (n + 6, rows[0][1], None)]
    rows += [(n + 7, [], 0), (n + 8, [1.0, 2.0], 0), (n + 9, [2.0, 4.0], 0), (None, rows[8][1], 2)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("block", [3, 1024])
def test_pivot_index(spark, rows, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    data, df = vectors(spark)

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        if a[2] is None or a[2] != b[2] or not usable(a[1]) or not usable(b[1]) or len(a[1]) != len(b[1]):
            return False
        x, y = np.array(a[1]), np.array(b[1])
        return x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93

    part = components(data, linked)
    want = []
    for i, row in enumerate(data):
        ids = [d[0] for d, p in zip(data, part, strict=True) if p == part[i] and d[0] is not None]
        low = min(ids, default=None)
        links = sum(linked(row, other) for j, other in enumerate(data) if j != i)
        want.append((row[0], links, low, row[0] == low))
    got = embedding_dedup.near_duplicates(df, pivots=64)
    assert sorted(rows(got), key=str) == sorted(want, key=str)


def crowd(rows, dims, cosine):
    """Vectors of one label, a third around one centre with this mean pair cosine."""
    random = np.random.default_rng(11)
    data = random.standard_normal((rows, dims))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    third = rows // 3
    data[:third] = data[third] + np.sqrt(1 / cosine - 1) * data[:third]
    return data / np.linalg.norm(data, axis=1, keepdims=True)


@pytest.mark.parametrize("block", [200, None])
def test_pivot_index_loses_no_link_in_a_dense_group(spark, monkeypatch, block):
    """Production parameters; with blocks of 200 the cells are many and the bounds at work."""
    if block:
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    data = crowd(3000, 64, 0.94)
    links = (data @ data.T >= 0.93).sum(axis=1) - 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert links.sum() > 500_000
    assert got == dict(enumerate(links.tolist()))


@pytest.mark.parametrize("around", [None, 0.75, 0.85])
def test_pivot_index_recall_of_single_partners(spark, around):
    """Pairs just above the threshold, scattered or around one centre that is too wide to link as a whole."""
    random = np.random.default_rng(11)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    one = unit(random.standard_normal((1500, 64)))
    if around:
        one = unit(unit(random.standard_normal((1, 64))) + np.sqrt(1 / around - 1) * one)
    off = random.standard_normal(one.shape)
    off = unit(off - (off * one).sum(axis=1, keepdims=True) * one)
    data = np.vstack([one, 0.931 * one + np.sqrt(1 - 0.931**2) * off])
    links = (data @ data.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(data)], "vec_id long, embedding array<double>, label int"
    )
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.98 * links.sum()


def test_lists_share_groups_up_to_a_size():
    first, count = embedding_dedup.group_lists(np.array([3, 4, 25, 2, 2, 9]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5]
    assert count.tolist() == [1, 1, 3, 1, 1, 1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert suffix_dedup.remove_repeats(docs, "doc_id", "text").count() == 0
    assert superkmer_dedup.remove_repeated_words(docs, "doc_id", "text").count() == 0
    assert simhash.near_duplicates(docs, "doc_id", "text").count() == 0
    assert simhash.keep_one(docs, "doc_id", "text").count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0
