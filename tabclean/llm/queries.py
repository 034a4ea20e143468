"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import column
from .bpe import token_digests
from .embedding_dedup import near_duplicates as near_vectors
from .merkle import merkle_manifest
from .multiset_hash import compare_with_next
from .oracles import OP11_SQL, OP12_SQL, OP13_SQL
from .packing import pack
from .quality import score_documents
from .sharding import interleave
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .superkmer_dedup import remove_repeated_words
from .url_filter import Rule, url_filter
from .vector_codes import compress_vectors
from .winnowing import decontaminate, folded

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, "doc_id", "text", keep_first=False, with_text=False)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", "fingerprint", "component_id")


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.93)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return score_documents(table(spark, sf_dir, "documents"), labels)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_digests(
        table(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.PATTERN
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", path).drop("input_ids")


def op9_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_words(docs, "doc_id", "text").drop("text")


def op10_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce(column("text"), F.lit("")), "utf-8")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    sharded = interleave(rows, "source", ["doc_id", "text_crc32", "size"], SHARDS)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate(docs, items, "doc_id", "text", "item_id", "text", window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(column("doc_id").cast("string")) % 3 == 0
    found = F.when(tampered, folded(column("text"))).otherwise(column("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    proved = merkle_manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", fields, {"text": found})
    return proved.drop("proof")


def op13_limb_split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return compress_vectors(vectors, "vec_id", "embedding", "label", parts=8, entries=16, rounds=6)


def all_queries() -> dict[str, Query]:
    found = [
        op1_suffix_array_dedup,
        op2_simhash,
        op3_pivot_index,
        op4_url_filter,
        op5_multiset_hash,
        op6_quality,
        op7_byte_bpe,
        op8_packing,
        op9_superkmer_dedup,
        op10_interleaved_shards,
        op11_winnowing,
        op12_merkle_manifest,
        op13_limb_split_codes,
    ]
    return {f.__name__: f for f in found}


OP4_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
ruled AS (
    SELECT *,
           CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                    THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                    THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
           END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def all_oracles() -> dict[str, str]:
    return {
        "op4_url_filter": OP4_SQL,
        "op11_winnowing": OP11_SQL,
        "op12_merkle_manifest": OP12_SQL,
        "op13_limb_split_codes": OP13_SQL,
    }
