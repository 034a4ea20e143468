"""The packing tokenizer's own splitting against the library, and clashing names in sharding."""

import random

import public_tokenizers
import pytest

from tabclean.llm.packing import Recent, WordCodec
from tabclean.llm.sharding import interleave

POOLS = [
    [chr(i) for i in range(256)],
    [chr(i) for i in range(32, 127)] + list("'''  sstt"),
    list("aAbBzZéÉßÿŸµªº '’…日本́̂ İıΣςσſKÅ<|>endoftext0123²½\x85\xa0\x1c\t\n"),
    ["<|endoftext|>", "<|ENDOFTEXT|>", " ", "a", "don't", "'S", "'ll", "I'VE", ".", "!!", "12", "é", "é"],
]


@pytest.fixture(scope="module")
def codec():
    return WordCodec(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_those_of_the_library(codec):
    rng = random.Random(11)
    for _ in range(8000):
        pool = rng.choice(POOLS)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        ids = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert codec.encode([text.encode()])[0].tolist() == ids, repr(text)


def test_ids_of_long_texts_cut_at_white_space(codec, monkeypatch):
    monkeypatch.setattr("tabclean.llm.packing.PART_BYTES", 50)
    text = "Grüße, it's 12.5 — or <|endoftext|> 日本語 " * 40 + "x" * 300
    assert codec.encode([text.encode()])[0].tolist() == codec.tokenizer.encode(text, add_special_tokens=False).ids


def test_what_is_kept_is_bounded_by_bytes():
    made = []

    def make(key):
        made.append(key)
        return key * 2

    kept = Recent(make, most=1 << 20)
    for i in range(20_000):
        assert kept[b"%d" % i] == b"%d%d" % (i, i)
        assert kept[b"often"] == b"oftenoften"
    assert len(kept) + len(kept.old) <= (1 << 20) // 200
    assert made.count(b"often") == 1
    long = b"x" * 5000
    assert kept[long] == long * 2 and long not in kept


def test_sharding_with_clashing_names(spark):
    names = "in_cell int, within_0 int, n int, before int, mix int, shard int, source string"
    df = spark.createDataFrame([(i, i % 3, 0, 1, 2, 9, f"s{i % 2}") for i in range(50)], names)
    found = interleave(df, "source", ["in_cell"], 4)
    assert sorted(found.columns) == sorted([*df.columns, "slot"])
    rows = found.collect()
    assert sorted(r["in_cell"] for r in rows) == list(range(50))
    assert sorted(sum(r["shard"] == s for r in rows) for s in range(4)) == [12, 12, 13, 13]
