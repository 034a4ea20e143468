"""Column types from stored text, by counts that merge in any order.

Every value has one narrowest kind, and a column's type is the narrowest that takes all its kinds:
int, bigint, decimal, double; date, timestamp; boolean; else string. Counting kinds is one narrow aggregate
over all columns, and the same counts tell how many values resist each type.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column, literal_rows

KINDS = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean", "string")
TAKES = {
    "int": ("int",),
    "bigint": ("int", "bigint"),
    "decimal": ("int", "bigint", "decimal"),
    "double": ("int", "bigint", "decimal", "double"),
    "date": ("date",),
    "timestamp": ("date", "timestamp"),
    "boolean": ("boolean",),
    "string": KINDS,
}
NUMBERS = ("int", "bigint", "decimal", "double")
DIGITS = 38  # of the largest decimal
WORDS = r"(?i)^[+-]?(nan|inf|infinity)$"
KNOWN_WORDS = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity", "Inf", "-Inf")


REPORT = "column_name string, type string, resisting bigint, fits boolean"


def kind(value: Column) -> Column:
    """The narrowest kind of a text; null for null. Padded numbers other than doubles are text."""
    whole = value.rlike(r"^[+-]?[0-9]+$")
    integer = (
        F.when(value.rlike(r"^[+-]?[0-9]{1,9}$") | value.try_cast("int").isNotNull(), "int")
        .when(value.try_cast("bigint").isNotNull(), "bigint")
        .when(digits(value) <= DIGITS, "decimal")
        .otherwise("double")
    )
    spoken = value.rlike(WORDS) & ~value.isin(*KNOWN_WORDS)
    return (
        F.when(value.isNull(), None)
        .when(whole, integer)
        .when(value.try_cast("double").isNotNull() & ~spoken, "double")
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), "date")
        .when(value.rlike("^[0-9+-]") & value.try_cast("timestamp").isNotNull(), "timestamp")
        .when(F.lower(value).isin("true", "false"), "boolean")
        .otherwise("string")
    )


def digits(value: Column) -> Column:
    """Digits of a whole number, leading zeros left out."""
    return F.length(F.regexp_replace(value, r"^[+-]?0*", ""))


def count_kinds(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, int]]:
    """Values of each kind by column, and the most ``digits`` of a whole number. One narrow aggregate; as many
    numbers as columns and kinds reach the driver."""
    if not cols:
        return {}
    kinds = df.select(*[F.struct(kind(column(c)).alias("k"), column(c).alias("v")).alias(f"c{i}") for i, c in enumerate(cols)])
    counted = kinds.agg(
        *[
            F.count_if(F.col(f"c{i}.k") == k).alias(f"{k}_{i}")
            for i in range(len(cols))
            for k in KINDS
        ],
        *[
            F.max(F.when(F.col(f"c{i}.k").isin("bigint", "decimal"), digits(F.col(f"c{i}.v")))).alias(f"digits_{i}")
            for i in range(len(cols))
        ],
    ).first()
    return {
        c: {k: counted[f"{k}_{i}"] for k in KINDS} | {"digits": counted[f"digits_{i}"] or 0}
        for i, c in enumerate(cols)
    }


def resisting(counts: Mapping[str, int], type_: str) -> int:
    """How many values do not fit a type."""
    return sum(counts[k] for k in KINDS if k not in TAKES[type_])


def narrowest(counts: Mapping[str, int], among: Iterable[str] = KINDS) -> str:
    """The first of ``among`` that takes all values, or takes the most of them; string without values."""
    if not any(counts[k] for k in KINDS):
        return "string"
    type_ = min(among, key=lambda t: resisting(counts, t))
    # 10 and 20 digits hold an int and a bigint of any value
    held = max([counts["digits"], *(n for n, k in ((10, "int"), (20, "bigint")) if counts[k])])
    return f"decimal({min(held, DIGITS)},0)" if type_ == "decimal" else type_


def type_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, type, resisting, fits) for text columns: how many values resist each type, and
    whether it is the one chosen. Nulls resist nothing; an empty column is string."""
    cols = list(cols or [c for c, t in df.dtypes if t == "string"])
    rows = []
    for c, counts in count_kinds(df, cols).items():
        chosen = narrowest(counts).split("(")[0]
        rows += [(c, t, resisting(counts, t), t == chosen) for t in KINDS]
    if not rows:
        return literal_rows(df.sparkSession, [("", "", 0, False)], REPORT).where(F.lit(False))
    return literal_rows(df.sparkSession, rows, REPORT)
