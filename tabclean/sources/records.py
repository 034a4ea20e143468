"""Records of CSV files as text, one row each, in parts that many tasks read at once.

A file without quoted line breaks is cut at any line. With quoted line breaks a line may start inside
a quoted field; whether it does follows from the number of quotes before it in the file. The quotes
of every scan split are counted first, and their running sum over the splits of a file says how
each split begins. So a file of any size is read by as many tasks as it has splits, and only the
records that lie across a border are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column

FILE, BLOCK, AT, RECORD = "file", "block", "at", "record"
NOT_A_FIELD = "\x01"  # as separator and without a quote character, the CSV reader gives whole lines
MOST_SPLITS = 4_000_000  # the way each begins is sent to all tasks, in about 16 bytes


def header_record(spark: SparkSession, path: str | list[str]) -> str | None:
    """The first line of one of the files; None if they are all empty."""
    lines = _lines(spark, path).where((F.col(BLOCK) == 0) & (F.trim("line") != "")).limit(1)
    first = lines.select("line").first()
    return first["line"].removesuffix("\r") if first else None


def line_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, at, record) for every line that isn't blank, without the files' header lines.

    ``block`` is where the scan split starts in the file and ``at`` grows along it, so sorting by the
    first three columns gives the order of the files. A file whose header line differs from the others'
    stops the job.
    """
    header = header_record(spark, path)
    whole = header or "record"
    odd = f"_{whole}"
    fields = T.StructType([T.StructField(name, T.StringType()) for name in (whole, odd)])
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("sep", NOT_A_FIELD)
        .option("quote", "")
        .option("columnNameOfCorruptRecord", odd)
    )
    lines = reader.schema(fields).csv(path)
    # Spark keeps a line that does hold the separator as a whole in the second column
    line = F.coalesce(column(odd), column(whole))
    return lines.select(*_place(), F.monotonically_increasing_id(), line).toDF(FILE, BLOCK, AT, RECORD)


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Like :func:`line_records` for files whose quoted fields may hold line breaks.

    Every quote that belongs to a field's value must be doubled and its field quoted; else records run together
    up to the next quote. Line breaks inside a field stay as they are, but for a file whose header line ends in a
    carriage return and line feed, where that pair is a line feed.
    """
    lines = _lines(spark, path)
    starts = _split_starts(lines)
    splits, inside = starts.agg(F.count(F.lit(1)), F.count_if("inside")).first()
    if splits > MOST_SPLITS:
        raise ValueError(f"{splits} scan splits; raise spark.sql.files.maxPartitionBytes")
    odd = starts.where("inside or crlf")
    lines = lines.join(F.broadcast(odd), [FILE, BLOCK], "left").select(
        FILE, BLOCK, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("inside", "crlf")], "line"
    )
    cut = lines.mapInArrow(_records, f"{FILE} string, {BLOCK} long, {AT} long, {RECORD} string, part string")
    if inside:
        cut = _joined(cut)
    first = (F.col(BLOCK) == 0) & (F.col(AT) == 0)
    header = header_record(spark, path)
    same = F.when(
        F.lower(RECORD) != F.lower(F.lit(header or "")),
        F.raise_error(F.concat(F.lit(f"header differs from {header}: "), F.col(RECORD))).cast("boolean"),
    ).otherwise(F.lit(False))
    return cut.select(FILE, BLOCK, AT, RECORD).where(F.when(first, same).otherwise(F.col(RECORD) != ""))


def _place() -> list[Column]:
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line) as stored, carriage returns included."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(*_place(), "value").toDF(FILE, BLOCK, "line")


def _split_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside, crlf): whether a split's first line starts inside a quoted field, and how
    the first line of its file ends."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    # Along a split the numbers grow, so the least has its first line
    ends = F.min_by(F.endswith("line", F.lit("\r")), "number")
    numbered = lines.withColumn("number", F.monotonically_increasing_id())
    counts = numbered.groupBy(FILE, BLOCK).agg(F.sum(quotes).alias("quotes"), ends.alias("crlf"))
    along = Window.partitionBy(FILE).orderBy(BLOCK)  # as many rows as a file has splits
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        FILE,
        BLOCK,
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        F.first("crlf").over(along).alias("crlf"),
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the lines of each record. ``part`` marks what reaches over the split's border: ``open``
    the beginning of a record whose end comes later, ``more`` what belongs to an earlier one."""
    place: tuple | None = None
    inside = crlf = False
    kept: list[str] = []  # lines of the record that isn't complete yet
    part, at = None, 0
    rows: list[tuple] = []

    def close(ended: bool) -> None:
        nonlocal at, kept, part
        if kept:
            text = "\n".join([line.removesuffix("\r") for line in kept] if crlf else kept)
            # Blank lines ahead of the header don't count
            if at or text.strip() or place[1] or part:
                rows.append((*place, at, text.removesuffix("\r") if ended else text, part if ended else part or "open"))
                at += 1
        kept, part = [], None

    for batch in batches:
        files, blocks, insides, crlfs, lines = batch.columns
        changes = _runs(files, blocks)
        for a, b in zip(changes[:-1], changes[1:], strict=True):
            here = (files[a].as_py(), blocks[a].as_py())
            if here != place:
                close(not inside)
                place, at, inside, crlf = here, 0, insides[a].as_py(), crlfs[a].as_py()
                part = "more" if inside else None
            mine = lines.slice(a, b - a)
            quotes = pc.count_substring(mine, '"').to_numpy(zero_copy_only=False)
            after = (np.cumsum(quotes) + inside) % 2 == 1
            opens = np.concatenate([[not inside], ~after[:-1]])  # lines that begin a record
            texts = mine.to_pylist()
            heads = [*np.flatnonzero(opens).tolist(), len(texts)]
            kept += texts[: heads[0]]
            for x, y in zip(heads[:-1], heads[1:], strict=True):
                close(True)
                kept = texts[x:y]
            inside = bool(after[-1])
            if len(rows) >= 4096:
                yield _as_batch(rows)
                rows.clear()
    close(not inside)
    if rows:
        yield _as_batch(rows)


def _runs(files: pa.Array, blocks: pa.Array) -> list[int]:
    """Where another split's lines begin, from 0 to the number of lines."""
    n = len(files)
    if n < 2:
        return [0, n] if n else [0]
    one = pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    two = pc.not_equal(blocks.slice(1), blocks.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(one | two) + 1).tolist(), n]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[FILE, BLOCK, AT, RECORD, "part"])


def _joined(cut: DataFrame) -> DataFrame:
    """Put together what lies across borders: at most two parts a split, found without their text."""
    whole = cut.where(F.col("part").isNull())
    parts = cut.where(F.col("part").isNotNull())
    along = Window.partitionBy(FILE).orderBy(BLOCK, AT)
    begun = F.last(F.when(F.col("part") == "open", F.struct(BLOCK, AT)), ignorenulls=True).over(along)
    owners = parts.select(FILE, BLOCK, AT, begun.alias("own"))
    parts = parts.join(owners, [FILE, BLOCK, AT]).groupBy(FILE, "own").agg(
        F.array_sort(F.collect_list(F.struct(BLOCK, AT, RECORD))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p[RECORD]), "\n")
    text = F.regexp_replace(text, "\r$", "")
    return whole.select(FILE, BLOCK, AT, RECORD).unionByName(
        parts.select(FILE, F.col(f"own.{BLOCK}"), F.col(f"own.{AT}"), text.alias(RECORD))
    )
