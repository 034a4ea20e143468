"""Raw CSV scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column
from ..operators.names import normalized_name
from .inference import NUMBERS, count_kinds, narrowest
from .records import AT, BLOCK, FILE, RECORD, line_records, quoted_records
from .scratch import materialize

ON_BAD = ("error", "null", "drop")
NUMERIC = "numeric"  # a type of its own: a number, of the type that the data tell


@dataclass(frozen=True)
class RawScan:
    """Records of CSV files, taken apart but not yet typed, with their place in the files."""

    fields: DataFrame  # file, block, at, record, f0, f1, ..., odd
    header: tuple[str, ...]
    types: Mapping[str, str | None]  # by header name; None is text

    def _values(self) -> list[tuple[str, str, Column, Column]]:
        """(name, type, text, typed value) of each column."""
        out = []
        for i, name in enumerate(self.header):
            text, dtype = F.col(f"f{i}"), self.types[name] or "string"
            out.append((name, dtype, text, text if dtype == "string" else text.try_cast(dtype)))
        return out

    def _surplus(self) -> Column:
        """True for a record with more fields than the header. Spark keeps the text of records whose number of
        fields is not the header's; too few are filled with nulls and pass."""
        one = r',(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'
        fields = F.regexp_count(F.concat(F.lit(","), F.col("odd")), F.lit(one))
        return F.col("odd").isNotNull() & (fields > len(self.header))

    def _tests(self) -> list[tuple[Column, Column]]:
        """(whether a record is bad, why) in the order in which reasons are told."""
        much = F.concat(F.lit(f"more than {len(self.header)} fields: "), F.col(RECORD))
        tests = [(self._surplus(), much)]
        for name, dtype, text, value in self._values():
            if dtype != "string":
                why = F.concat(F.lit(f"column {name}: not of type {dtype}: "), text)
                tests.append((text.isNotNull() & value.isNull(), why))
        return tests

    def _reason(self) -> Column:
        return F.coalesce(*[F.when(bad, why) for bad, why in self._tests()])

    def rows(self, on_bad_value: str = "error", place: str | None = None) -> DataFrame:
        """The typed table. Which rows it has, and whether it stops, is the same whatever columns are
        read from it. ``place`` names a column to be put in front, which sorts rows as in the files."""
        if on_bad_value not in ON_BAD:
            raise ValueError(f"on_bad_value must be one of {ON_BAD}, not {on_bad_value!r}")
        df = self.fields
        bad = reduce(or_, [test for test, _ in self._tests()])
        if on_bad_value == "error":
            stop = F.raise_error(self._reason()).cast("boolean")
            df = df.where(F.when(bad, stop).otherwise(F.lit(True)))
        elif on_bad_value == "drop":
            df = df.where(~bad)
        first = [F.struct(FILE, BLOCK, AT).alias(place)] if place else []
        return df.select(*first, *[value.alias(name) for name, _, _, value in self._values()])

    def bad_records(self) -> DataFrame:
        """(file, record, reason) of every record that has surplus fields or a value not of its type."""
        bad = reduce(or_, [test for test, _ in self._tests()])
        return self.fields.where(bad).select(FILE, RECORD, self._reason().alias("reason"))

    def preview(self, n: int = 5, on_bad_value: str = "error") -> DataFrame:
        """The first rows in the order of the files, with their ``position`` from 1 in front.

        Each task keeps ``n`` rows of its own, so nothing is sorted as a whole.
        """
        place, position = "place", "position"
        while place in self.header:
            place = f"_{place}"
        while position in self.header:
            position = f"_{position}"
        first = self.rows(on_bad_value, place).orderBy(place).limit(n)
        row = F.struct(column(place), *[column(c).alias(f"f{i}") for i, c in enumerate(self.header)])
        listed = first.agg(F.array_sort(F.collect_list(row)).alias("rows"))
        shown = listed.select(F.posexplode("rows").alias("i", "row"))
        fields = [F.col(f"row.f{i}").alias(name) for i, name in enumerate(self.header)]
        return shown.select((F.col("i") + 1).alias(position), *fields)


def scan_raw(
    spark: SparkSession,
    path: str | list[str],
    types: Mapping[str, str],
    multiline: bool = False,
    infer_rest: bool = False,
    store: bool = False,
) -> RawScan | None:
    """Take CSV files with a header row apart; see :func:`read_raw`. None where there is no header.

    With ``store``, and always where types come from the data, the text of the fields is stored as
    a scratch table, from which types and all that follows are read: the files are parsed once.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    header = tuple(reader.csv(path).columns)
    if not header:
        return None
    wanted = {name: types.get(normalized_name(name)) for name in header}
    open_ = [name for name in header if wanted[name] == NUMERIC or (infer_rest and wanted[name] is None)]
    records = quoted_records(spark, path) if multiline else line_records(spark, path)
    fields = _fields(records, len(header), multiline)
    if store or open_:
        fields = materialize(fields, "raw-fields")
    counts = count_kinds(fields, [f"f{header.index(name)}" for name in open_])
    for name in open_:
        kinds = counts[f"f{header.index(name)}"]
        wanted[name] = narrowest(kinds, NUMBERS) if wanted[name] == NUMERIC else narrowest(kinds)
        if wanted[name] == "string" and types.get(normalized_name(name)) == NUMERIC:
            wanted[name] = "double"  # a number by its spec, without any value
    return RawScan(fields, header, wanted)


def _fields(records: DataFrame, n: int, multiline: bool) -> DataFrame:
    schema = ", ".join([f"f{i} string" for i in range(n)] + ["odd string"])
    options = {
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "odd",
        "multiLine": str(multiline).lower(),
    }
    parsed = F.from_csv(F.col(RECORD), schema, options)
    # A generator, so that a record is parsed once however many of its fields are asked for
    return records.select(FILE, BLOCK, AT, RECORD, F.inline(F.array(parsed)))


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    types: Mapping[str, str] | None = None,
    multiline: bool = False,
    on_bad_value: str = "error",
    infer_rest: bool = False,
) -> DataFrame:
    """Read CSV files with a header row. A doubled quote inside a quoted field is one quote.

    * ``schema``: used as given, by position.
    * ``types``: Spark type per *normalised* column name, or ``"numeric"`` for a number of the type that
      the data tell; all other columns are strings, or with ``infer_rest`` of the narrowest type that
      fits all their values. The header line is looked up once (a small task), so column order in the file does
      not matter, and every file's own header line is checked against it.
    * neither: types are inferred, which costs a full extra pass and turns ``007`` into ``7``.

    With ``types``, a value that does not fit its type and a record with more fields than the header
    stop the job, whatever columns are read and whatever the session's ANSI mode; with ``on_bad_value="null"``
    the value becomes null and surplus fields are left out, with ``"drop"`` the record is. :func:`scan_raw` gives
    the records concerned. Short records are filled with nulls. Empty fields are null.

    Where types come from the data, the fields are stored as text once, and counted and read there:
    the files are parsed once.

    ``multiline=True`` accepts quoted line breaks, in files that are split like any other.
    """
    if on_bad_value not in ON_BAD:
        raise ValueError(f"on_bad_value must be one of {ON_BAD}, not {on_bad_value!r}")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if types is None:
        return reader.option("inferSchema", True).csv(path)
    scan = scan_raw(spark, path, types, multiline, infer_rest)
    return scan.rows(on_bad_value) if scan else reader.csv(path)
