"""Curated Parquet sink."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_curated(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write a table as Parquet, replacing the whole target by default.

    The replacement is written to a hidden folder beside the target and takes its place by renaming
    once it is whole. A job that fails half way leaves the old table as it was, and a table may be
    replaced by rows read from itself. Whoever reads the old files during the switch must read
    again; on stores without a rename, the switch is a copy.

    With ``partition_by`` the rows are rebalanced on those columns first: each folder gets few,
    evenly sized files, and a folder that holds much of the table is split over several tasks.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df

    def write(to: str, how: str) -> None:
        writer = rows.write.mode(how)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(to)

    if mode != "overwrite":
        write(path, mode)
        return
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        write(path, "errorifexists")
        return
    new, old = (target.suffix(f".{what}-{uuid.uuid4().hex}") for what in ("new", "old"))
    new, old = (_hidden(spark, p) for p in (new, old))
    try:
        write(new.toString(), "errorifexists")
        if not files.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(new, target):
            files.rename(old, target)
            raise OSError(f"cannot move the new table to {path}")
        files.delete(old, True)
    finally:
        files.delete(new, True)


def _hidden(spark, path):
    """The path with a dot ahead of its last part, which scans of the parent folder pass over."""
    return spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}")
