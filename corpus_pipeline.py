"""A training-data pipeline: quality, near-duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is stored before the next stage
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclean.functions import column
from tabclean.llm.common import fresh
from tabclean.llm.packing import pack
from tabclean.llm.quality import keep_good
from tabclean.llm.simhash import keep_one
from tabclean.llm.suffix_dedup import RESULTS, remove_repeats
from tabclean.sources.scratch import materialize, scratch_scope

ORACLE_SQL = None  # learned scores, fingerprints and token ids have no SQL form


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier scores below 0.3. Rows are kept or dropped whole."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return keep_good(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the least id, of each SimHash component: 3 words, 3 bits."""
    return keep_one(docs, "doc_id", "text", words=3, max_bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of every string of 200 bytes; the first copy stays. n_chars follows the text."""
    clash = [c for c in docs.columns if c.lower() in RESULTS]
    taken = docs.withColumns({name: F.lit(0) for name in RESULTS})
    kept = dict(zip(clash, fresh(taken, *[f"input_{c}" for c in clash]), strict=True))
    cut = remove_repeats(docs.withColumnsRenamed(kept), "doc_id", "text", keep_first=True)
    cut = cut.drop(*RESULTS).select(*[column(kept.get(c, c)).alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 with the pieces of all documents."""
    return pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored in the shared scratch folder.

    All but the result of the last stage is removed at the end.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_scope(spark):
        for name, stage in STAGES:
            last = name == STAGES[-1][0]
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=last)
    return docs
