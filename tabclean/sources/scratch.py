"""Scratch tables in the folder all executors share.

A table written here cuts lineage: losing an executor later costs a re-read of a few files, not a
re-run of the shuffle that built them. Parquet also keeps later passes narrow.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_scopes: list[list[str]] = []  # paths made in each open scope, innermost last


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder stands in, on a local master only: on a cluster
    a folder of one machine would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="tabclean-")
    return _local_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a scratch table."""
    return f"{scratch_root(spark)}/tabclean/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a scratch table and return the frame that reads it back.

    The table goes at the end of the innermost :func:`scratch_scope`, unless ``keep`` says otherwise;
    without a scope it stays until the folder is emptied.
    """
    path = scratch_path(df.sparkSession, name)
    if _scopes and not keep:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that are made inside the block are removed at its end.

    What the block leaves behind must have been written elsewhere by then.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            _remove(spark, path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`materialize`, and the scratch table is removed at the end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
