"""Filters, fingerprints, classifier, tokens, packing, shards, pipeline."""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tabclean.llm import bpe, multiset_hash, packing, quality, queries, sharding
from tabclean.llm.memo import Memo
from tabclean.llm.sharding import interleave
from tabclean.llm.url_filter import Index, Rule, build_index, url_filter
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_url_rules(spark, rows):
    urls = [
        "http://a.example.net/en/1", "http://example.net/de", "http://notexample.net", "HTTP://X.ORG/fr/?q#f",
        "https://www.Example.COM/de/?x", "http://example.com?de/", "mailto:a", None, "", "://", "x://y://z/net",
    ]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = url_filter(df, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    assert rows(got) == [
        (0, "a.example.net", "/en/1", "example.net/en/", "allow"),
        (1, "example.net", "/de", "net/", "block"),
        (2, "notexample.net", "", None, "allow"),
        (3, "x.org", "/fr/", "org/fr/", "allow"),
        (4, "www.example.com", "/de/", "example.com/de/", "block"),
        (5, "example.com", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "", "", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (10, "y:", "//z/net", None, "allow"),
    ]
    assert url_filter(df.limit(0), []).count() == 0
    assert {r["verdict"] for r in url_filter(df, [], default="block").collect()} == {"block"}


def test_url_index_confirms_strings(tmp_path):
    path = tmp_path / "index"
    path.write_bytes(build_index([Rule("block", "B.com", "/"), Rule("allow", "b.com", "/")]))
    index = Index(str(path))
    assert index.judge([b"x.b.com"], [b"/q"]) == [(b"b.com/", b"block")]
    index.strings = np.frombuffer(b"c.com\0/\0block", np.uint8)  # a collision: another string
    assert index.judge([b"x.b.com"], [b"/q"]) == [None]
    with pytest.raises(ValueError):
        build_index([Rule("deny", "a", "")])


def test_multiset_hash_follows_edits():
    parts = [b"one two", b"three", b"three", b"four five six"]
    whole = multiset_hash.fingerprint(b"\n".join(parts))
    assert np.array_equal(whole, multiset_hash.fingerprint(b"\n\n".join(reversed(parts))))
    fewer = multiset_hash.fingerprint(b"\n".join(parts[:2]))
    assert np.array_equal(multiset_hash.insert(fewer, parts[2:]), whole)
    assert np.array_equal(multiset_hash.delete(whole, parts[2:]), fewer)
    assert not np.array_equal(whole, fewer)
    assert not multiset_hash.fingerprint(b" \n").any()
    assert multiset_hash.likeness(whole, whole) == 1.0


def test_likeness_of_very_frequent_lines():
    """A line that occurs more than 32,767 times does not wrap a lane."""
    many, half = (multiset_hash.fingerprint(b"one line\n" * n) for n in (40_000, 20_000))
    assert multiset_hash.likeness(many, half) == pytest.approx(1.0)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_next_document(spark, docs, corpus, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = multiset_hash.compare_with_next(docs, "doc_id", "text").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in corpus)
    unique = Counter(i for i, _ in corpus)
    order = sorted((i for i in unique if i is not None), reverse=True)
    text = {i: t or "" for i, t in corpus}
    by_id = {r["doc_id"]: r for r in got}
    for one, following in zip(order, order[1:], strict=False):
        if unique[one] == unique[following] == 1:
            t, row = text[one], by_id[one]
            half = len(t) // 2
            edited = t[: len(t) - half] + text[following][:half]
            assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert row["edited_fingerprint"] == multiset_hash.to_hex(multiset_hash.fingerprint(edited))
            assert 0 <= row["near_next"] <= 1 and row["n_chars"] == len(t)
    assert by_id[20]["fingerprint"] == by_id[21]["fingerprint"]
    assert multiset_hash.compare_with_next(docs.limit(0), "doc_id", "text").count() == 0


def test_quality_separates(spark, passage):
    good = [(i, passage(i, 60), 1) for i in range(60)]
    bad = [(100 + i, passage(500 + i, 40).upper().replace(" ", "!! "), 0) for i in range(40)]
    rows = good + bad
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == 101 and all(0 <= r["score"] <= 1 for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == truth[r["doc_id"]] for r in held)
    kept = quality.keep_good(docs.where("doc_id is not null"), labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, y in truth.items() if y}
    assert quality.score_documents(docs, labels.limit(0)).count() == 101
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_quality_of_long_texts_in_parts():
    text = b"one two three!! " * 40_000
    whole, counts = quality.counted(text)
    assert len(whole) == len(counts) and counts.sum() > len(text)
    assert quality.counted(b"")[0].size == 0


def test_bpe_equals_tiktoken(docs, corpus):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in corpus:
        ids = other.encode_ordinary(t or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), listed, hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.token_digests(docs, "doc_id", "text", RANKS, public_tokenizers.PATTERN)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    encoded = bpe.encode(docs, "text", RANKS, public_tokenizers.PATTERN, offsets=True)
    back = bpe.decode(encoded, "ids", RANKS, public_tokenizers.PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)


def test_bpe_offsets_and_split_characters(monkeypatch):
    codec = bpe.load(RANKS, public_tokenizers.PATTERN)
    text = "a 日本 😀é"
    ids, start, end = codec.encode_with_offsets(text)
    for i, a, b in zip(ids, start, end, strict=True):
        assert codec.decode_bytes(np.array([i])) in text[a:b].encode()
    assert codec.decode(ids) == text
    half = next(i for i in range(len(ids)) if start[i] == text.index("😀"))
    assert "\ufffd" in codec.decode(ids[: half + 1]) or codec.decode(ids[: half + 1]).endswith("😀")
    monkeypatch.setattr(bpe, "BATCH_CHARS", 5)
    long = "one two  three\n four 's five"
    assert codec.encode_batch([long])[0].tolist() == codec.tokenizer.encode(long).ids


def test_memo_stays_bounded():
    memo = Memo(lambda keys: [k.upper() for k in keys], most=10)
    for i in range(100):
        memo.fill([["the", f"w{i}"]])
        assert memo["the"] == "THE" and memo[f"w{i}"] == f"W{i}"
        assert len(memo) <= 12


def test_memo_keeps_no_long_strings():
    memo = Memo(lambda keys: [len(k) for k in keys])
    for i in range(50):
        long = f"{i}" * 2000
        memo.fill([["the", long]])
        assert memo["the"] == 3 and memo[long] == len(long)
        assert sum(map(len, memo)) <= 3 + 4000


def test_best_fill_is_optimal():
    random = np.random.default_rng(2)
    for _ in range(60):
        counts = Counter(random.integers(3, 40, random.integers(1, 7)).tolist())
        capacity = int(random.integers(20, 90))
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = packing.best_fill(dict(counts), capacity)
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= capacity)
        assert all(n <= counts[k] for k, n in used.items())


@pytest.mark.parametrize("run_tokens", [500, 1 << 21])
def test_packing(docs, corpus, monkeypatch, run_tokens):
    monkeypatch.setattr(packing, "RUN_TOKENS", run_tokens)
    tokenizer = Tokenizer.from_file(WORDS)
    got = packing.pack(docs, "doc_id", "text", WORDS, capacity=256).collect()
    want = Counter()
    for i, t in corpus:
        want[i, struct.pack("<q", 0) and len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    starts = Counter((r["doc_id"], r["doc_tokens"]) for r in got if r["start"] == 0)
    assert starts == want
    assert sum(r["length"] for r in got) == sum(size * n for (_, size), n in want.items())
    text = {i: t for i, t in corpus if i in (22, 63, 80)}
    for i, t in text.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        pieces = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["input_ids"]) for r in pieces) == struct.pack(f"<{len(ids)}I", *ids)
        assert all(zlib.crc32(bytes(r["input_ids"])) == r["ids_crc32"] for r in pieces)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in sequences.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 256 and at & (at - 1) == 0
    assert packing.pack(docs.limit(0), "doc_id", "text", WORDS).count() == 0


@pytest.mark.parametrize("shards", [1, 5, 100])
def test_interleave(docs, corpus, shards):
    got = interleave(docs, "source", ["doc_id", "text"], shards).collect()
    assert len(got) == len(corpus) and Counter(r["doc_id"] for r in got) == Counter(i for i, _ in corpus)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    if shards == 5:
        mix = Counter((r["shard"], r["source"]) for r in got)
        for source in ("s0", "s1", "s2"):
            counts = [mix[s, source] for s in range(5)]
            assert max(counts) - min(counts) <= 2
    assert interleave(docs.limit(0), "source", ["doc_id"], 3).count() == 0


def test_small_sources_spread_over_the_grid(spark):
    """Rows of sources of one size do not all fall into one cell, which one task would rank."""
    ranks = spark.range(20_000).select(F.xxhash64("id").alias("mix"), F.lit(1).alias("r"), F.lit(1).alias("n"))
    cells = ranks.select(F.floor(sharding.fraction(F.col("r"), F.col("n"), F.col("mix")) * sharding.GRID).alias("c"))
    counts = [r["count"] for r in cells.groupBy("c").count().collect()]
    assert len(counts) > 3500 and max(counts) < 30
    lone = spark.range(500).select("id", F.col("id").cast("string").alias("source"))
    got = interleave(lone, "source", ["id"], 4).groupBy("shard").count().collect()
    assert sorted(map(tuple, got)) == [(i, 125) for i in range(4)]


def test_sharding_has_no_python(spark, plan):
    text = plan(queries.op10_interleaved_shards(spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text


def test_repeated_passages_keeps_columns_named_like_results(spark, passage):
    import corpus_pipeline

    rows = [(i, f"{passage(3, 80)} {passage(100 + i, 30)}", -i, f"mine {i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long, Kept_sha256 string")
    got = corpus_pipeline.repeated_passages(spark, docs, "")
    assert got.columns == docs.columns
    found = sorted((r["doc_id"], r["n_bytes"], r["Kept_sha256"]) for r in got.collect())
    assert found == [(i, -i, f"mine {i}") for i in range(3)]


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, stage = stage, function(spark, stage, sf)
        assert stage.columns == docs.columns, name
        assert stage.join(before, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {
        r["doc_id"] for r in stage.select("doc_id").collect()
    }
