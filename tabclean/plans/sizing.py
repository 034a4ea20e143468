"""Shuffle and scan sizes that follow the input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITION_BYTES = 256 << 20  # raw input per shuffle partition; give less for compressed input


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Total size of the files under one or more paths, globs included."""
    total = 0
    for one in [path] if isinstance(path, str) else path:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(one)
        files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for match in files.globStatus(pattern) or []:
            total += files.getContentSummary(match.getPath()).getLength()
    return total


def size_settings(
    size: int, partitions: int, partition_bytes: int = PARTITION_BYTES, split_bytes: int | None = None
) -> dict[str, str]:
    """Session settings for ``size`` bytes of raw input; never fewer than ``partitions``.

    Adaptive execution merges small shuffle partitions at run time but cannot split those of an
    aggregate, so the count must start high enough for the input.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(partitions, -(-size // partition_bytes))),
    }
    if split_bytes:
        settings["spark.sql.files.maxPartitionBytes"] = str(split_bytes)
    return settings


@contextmanager
def sized_for(
    spark: SparkSession,
    path: str | list[str],
    partition_bytes: int = PARTITION_BYTES,
    split_bytes: int | None = None,
) -> Iterator[None]:
    """Apply :func:`size_settings` for the files under ``path``, and put the old ones back.

    Use it around :func:`clean_table` and :func:`profile_table` too, with the action inside.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    settings = size_settings(input_bytes(spark, path), partitions, partition_bytes, split_bytes)
    old = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
