"""Decontamination, Merkle manifest and vector codes against plain Python, and their edge cases."""

import hashlib
import math
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclean.llm import queries, vector_codes, winnowing
from tabclean.llm.merkle import fold, merkle_manifest, sweep, sweep_back
from tabclean.llm.vector_codes import compress_vectors, exact_dots, integers, limbs, nearest
from tabclean.llm.winnowing import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def leaks(docs, items, window):
    """Brute force: (id, words, hit words, items) of every text."""
    known = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            known.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, met = WORD.findall(lowered(text)), set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in known:
                    hit |= set(range(i, i + size))
                    met |= known[tuple(words[i : i + size])]
        out.append((doc, len(words), len(hit), tuple(sorted(met)), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(passage):
    shared = passage(2, 60)
    return [
        (1, shared),
        (2, passage(2, 60)[:120]),
        (3, "Don't STOP"),  # shorter than a window
        (3, passage(300, 30)),  # an id with two texts
        (4, passage(301, 9)),
        (None, passage(10, 12)),
        (None, None),
        (5, ""),
        (6, " -- "),
        (7, passage(1, 90)),
        (7, passage(1, 90)),
        (8, "é…日本́ ñandú x"),
        (9, "ΑΣ"),
        (10, "İ"),
    ]


@pytest.mark.parametrize("window", [1, 4, 10])
def test_leaks_equal_brute_force(spark, docs, corpus, items, passage, window):
    more = [
        (90, "do NOT; Don't stop! now"),
        (91, "Don't"),
        (92, f"{passage(7, 5)} {passage(301, 9).upper()} {passage(8, 5)}"),
        (93, "ΑΣ.Β ΑΣ ας"),
        (94, "İ i̇ é"),
        (95, passage(2, 60).replace(" ", "\x00\n--")),
    ]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    texts = docs.select("doc_id", "text").union(extra)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate(texts, benchmark, "doc_id", "text", "item_id", "text", window).collect()
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found]
    assert sorted(rows, key=repr) == leaks(corpus + more, items, window)
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


def test_leaks_across_pieces(spark, passage, monkeypatch):
    """Windows over the border of two pieces of a long text are found."""
    monkeypatch.setattr(winnowing, "PIECE", 64)
    shared = [passage(400 + i, 25) for i in range(6)]
    text = " ".join(f"{passage(500 + i, 40 + i)} {shared[i % 6]}" for i in range(18))
    texts = [(1, text), (2, passage(600, 64)), (3, f"{passage(601, 59)} {shared[0]}")]
    items = list(enumerate(shared))
    found = decontaminate(
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id int, text string"),
        "doc_id", "text", "item_id", "text",
    )
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found.collect()]
    assert sorted(rows, key=repr) == leaks(texts, items, 10)


def test_leaks_of_empty_tables_and_clashing_names(spark, docs):
    none = docs.select("doc_id", "text").limit(0)
    some = spark.createDataFrame([("a", "x y z")], "item_id string, text string")
    assert decontaminate(none, some, "doc_id", "text", "item_id", "text").collect() == []
    clean = decontaminate(docs, some.limit(0), "doc_id", "text", "item_id", "text")
    assert clean.where("contaminated or n_hit > 0 or size(items) > 0").count() == 0
    assert clean.count() == docs.count()
    names = "id long, text string, k1 int, words int, base int, prints string, met int, shown int, item int"
    odd = spark.createDataFrame([(1, "x Y z", 1, 2, 3, "p", 4, 5, 6)], names)
    found = decontaminate(odd, odd, "id", "text", "item", "text").first()
    assert (found["id"], found["n_hit"], list(found["items"])) == (1, 3, ["6"])


def test_every_shared_window_shares_a_fingerprint(spark):
    """Equal windows have equal fingerprints wherever they stand, so none is missed."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, 60)) for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(winnowing.words_of(F.col("t")).alias("w"))
    seen = {}
    for r in winnowing.with_prints(df, "w", 10, "p").collect():
        assert len(r["p"]) == 51
        for i, p in enumerate(r["p"]):
            assert seen.setdefault(tuple(r["w"][i : i + 10]), p) == p


def test_decontamination_runs_no_python(spark):
    plan = queries.op11_winnowing(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests, fanout):
    """Top and the pairs of every leaf."""
    pairs, where, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for mine, w in zip(pairs, where, strict=True):
            start = w // fanout * fanout
            mine += ["".join(nodes[start:w]), "".join(nodes[w + 1 : start + fanout])]
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        where = [w // fanout for w in where]
    return nodes[0], pairs


def manifest(rows, fanout):
    """Brute force over (id, group, text, text as found)."""
    shown = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for i, group, text, now in rows:
        leaf, found = (sha(shown(i) + shown(group) + shown(t)) for t in (text, now))
        groups.setdefault(group, []).append((i is not None, i or 0, leaf, found, i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, upper = tree([trees[g][0] for g in order], fanout)
    out = []
    for g, above in zip(order, upper, strict=True):
        for (_, _, leaf, found, i), pairs in zip(sorted(groups[g]), trees[g][1], strict=True):
            digest = found
            for a, b in zip((pairs + above)[::2], (pairs + above)[1::2], strict=True):
                digest = sha(a + digest + b)
            proof = sha("".join(pairs + above))
            out.append((i, leaf, trees[g][0], root, proof, digest, digest == root))
    return sorted(out, key=repr)


def proved(spark, rows, fanout, span):
    df = spark.createDataFrame(rows, "id long, lang string, text string, now string")
    out = merkle_manifest(df, "id", "lang", ["id", "lang", "text"], {"text": F.col("now")}, fanout, span)
    return sorted((tuple(r) for r in out.drop("proof").collect()), key=repr)


@pytest.mark.parametrize(("fanout", "span"), [(8, 4), (2, 1), (3, 2)])
def test_manifest_equals_brute_force(spark, fanout, span):
    rows = [(i, "en", f"text {i}", f"text {i}" if i % 3 else "changed") for i in range(75)]
    rows += [(i, "de", None, None) for i in range(8)] + [(i, None, "", "") for i in range(9)]
    rows += [(1, "é", "x", "X"), (2, "", "y", "y"), (None, "z", None, "now here"), (None, "z", "a", None)]
    rows += [(7, "en", "text 7", "text 7")] * 3 + [(7, "en", "other", "other")] + [(i, "x" * i, "t", "t") for i in range(1, 12)]
    assert proved(spark, rows, fanout, span) == manifest(rows, fanout)


def test_manifest_of_one_row_and_of_none(spark):
    rows = [(5, "en", "x", "x")]
    (only,) = proved(spark, rows, 8, 4)
    assert only[1] == only[2] == only[3] == only[5] and only[4] == sha("") and only[6]
    empty = spark.createDataFrame([], "id string, lang string, text string")
    assert merkle_manifest(empty, "id", "lang", ["id", "text"]).collect() == []


def test_manifest_with_clashing_names(spark):
    names = "idx string, tree int, digest string, found string, block int, n int, pairs int, leaf string"
    rows = [("b", 1, "d", None, 1, 2, 3, "l"), ("a", 1, None, "f", 1, 2, 3, ""), (None, None, "", "", 0, 0, 0, None)]
    df = spark.createDataFrame(rows, names)
    found = merkle_manifest(df, "idx", "tree", ["idx", "digest", "found", "leaf"]).collect()
    assert sorted(r["idx"] or "" for r in found) == ["", "a", "b"]
    assert all(r["verified"] and fold(r["leaf"], r["proof"]) == r["root"] for r in found)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513])
def test_sweeps_go_forward_and_back(n):
    digests = [sha(str(i)) for i in range(n)]
    levels = 0
    while 8**levels < n:
        levels += 1
    top, nodes = sweep(digests, 8, levels)
    assert [x[:2] for x in nodes] == sorted(x[:2] for x in nodes)
    expected, pairs = tree(digests, 8)
    assert top == expected
    assert sweep_back(nodes, n, 8, ["L", "R"]) == [p + ["L", "R"] for p in pairs]


# Vector codes


@pytest.mark.parametrize("most", [3, 4096, 1 << 24, 1 << 27, 1 << 29])
def test_dots_are_exact(most):
    rng = np.random.default_rng(most)
    left, right = rng.integers(-most, most + 1, (50, 8)), rng.integers(-most, most + 1, (16, 8))
    left[0], right[0], right[1] = most, -most, most
    exact = left.astype(object) @ right.astype(object).T
    assert (exact_dots(left, right).astype(object) == exact).all()
    first, distance = nearest(left, right)
    full = ((left.astype(object)[:, None] - right.astype(object)[None]) ** 2).sum(axis=2)
    assert (first == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_limbs_stay_short_and_add_up():
    numbers = np.array([0, 1, -1, 1 << 40, -(1 << 40), (1 << 61) + 12345, -(1 << 61) - 7])
    parts = limbs(numbers, 13)
    assert all(np.abs(p).max() <= 1 << 13 for p in parts)
    assert sum(p.astype(np.int64).astype(object) * (1 << 13 * i) for i, p in enumerate(parts)).tolist() == numbers.tolist()


def codes(rows, parts, entries, rounds, scale=4096):
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    m = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * m : (p + 1) * m]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def near(v, p):
        every = [sum((a - b) ** 2 for a, b in zip(cut(v, p), entry, strict=True)) for entry in books[p]]
        return every.index(min(every)), min(every)

    for _ in range(rounds):
        chosen = [[near(v, p)[0] for _, _, v in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                if mine := [cut(v, p) for (_, _, v), c in zip(kept, chosen[p], strict=True) if c == e]:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    found = [(i, lab, [near(v, p) for p in range(parts)]) for i, lab, v in kept]
    total = {}
    for _, lab, near_parts in found:
        total[lab] = total.get(lab, 0) + sum(d for _, d in near_parts)
    long = lambda x: x if x < 1 << 63 else None
    return sorted(
        ((i, "".join(f"{c:02x}" for c, _ in f), long(sum(d for _, d in f)), long(total[lab]), digest) for i, lab, f in found),
        key=repr,
    )


@pytest.mark.parametrize("big", [1.0, 1e9, 1e30])
def test_codes_equal_brute_force(spark, big):
    rng = np.random.default_rng(int(big) % 97)
    rows = [(i, rng.normal(size=16).tolist(), None if i % 7 == 0 else i % 3) for i in range(60)]
    rows += [(i, [float(x * big) for x in rng.normal(size=16)], 1) for i in range(70, 76)]
    rows += [(80, None, 1), (81, [None] * 16, 1), (82, [math.nan] * 16, 2), (83, [math.inf] + [0.0] * 15, 2)]
    rows += [(3, rows[3][1], 0), (3, rows[9][1], 0), (None, rows[5][1], None), (90, [0.0] * 16, 5), (91, [0.0] * 16, 5)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int").repartition(5)
    found = compress_vectors(df, "id", "v", "label", parts=4, entries=5, rounds=3)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == codes(rows, 4, 5, 3)


def test_codes_with_a_hot_label_and_many_rare_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 7 if i % 3 == 0 else 100 + i) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label int")
    rows = [(r["id"], r["v"], r["label"]) for r in df.collect()]
    found = compress_vectors(df, "id", "v", "label", parts=2, entries=3, rounds=1)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == codes(rows, 2, 3, 1)


def test_codes_of_few_odd_and_no_vectors(spark):
    schema = "id long, v array<float>, label string, code int, error int, `of` int, vector int, rows int"
    some = spark.createDataFrame([(1, [1.0, 2.0], "a", 0, 0, 0, 0, 0), (2, [], "a", 0, 0, 0, 0, 0)], schema)
    (only,) = compress_vectors(some.where("id = 1"), "id", "v", "label", parts=2).collect()
    assert (only["id"], only["code"], only["error"], only["label_error"]) == (1, "0000", 0, 0)
    assert compress_vectors(some.limit(0), "id", "v", "label").collect() == []
    # vectors of another length than the common one, or of one that can't be cut, take no part
    assert [r["id"] for r in compress_vectors(some, "id", "v", "label", parts=2).collect()] == [1]
    assert compress_vectors(some.where("id = 1"), "id", "v", "label", parts=8).collect() == []


def test_codes_lose_little(spark):
    """Decoded vectors lie where their error says."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = vector_codes.kept_vectors(vectors, "vec_id", "embedding", "label", 8)
    books = vector_codes.train_codebooks(rows)
    coded = vector_codes.encode_vectors(rows, books).join(rows.select("id", "vector"), "id").collect()
    for r in coded[:50]:
        near = integers(np.array([books.decode(r["code"])]), 4096)[0]
        exact = integers(np.array([r["vector"]]), 4096)[0]
        assert int(((near - exact) ** 2).sum()) == r["error"]


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    df = queries.all_queries()[name](spark, SF)
    cursor = duck.execute(queries.all_oracles()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(names).collect()), key=repr)
    assert found == sorted(cursor.fetchall(), key=repr)
