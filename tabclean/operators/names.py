"""Column names: normalising, positional renaming, schema listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import literal_rows


def normalized_name(name: str) -> str:
    """Strip, lower-case, and turn inner spaces into underscores."""
    return name.strip().lower().replace(" ", "_")


def normalize_names(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Normalise every column name in one projection.

    Two headers can end up equal (``"A b"`` and ``"a_b"``). ``on_collision="error"`` refuses them
    here, before a later step fails on an ambiguous name; ``"suffix"`` numbers the later ones.
    """
    if on_collision not in ("error", "suffix"):
        raise ValueError(f"on_collision must be 'error' or 'suffix', not {on_collision!r}")
    names = [normalized_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        if on_collision == "error":
            clashes = sorted({n for n in names if names.count(n) > 1})
            raise ValueError(f"column names collide after normalising: {clashes}")
        taken = set(names)
        seen: set[str] = set()
        unique = []
        for name in names:
            final, n = name, 2
            if name in seen:
                while f"{name}_{n}" in taken:
                    n += 1
                final = f"{name}_{n}"
                taken.add(final)
            seen.add(name)
            unique.append(final)
        names = unique
    return df.toDF(*names)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the first ``len(names)`` columns; later columns keep their names."""
    if len(names) > len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names, *df.columns[len(names) :])


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: column_name, data_type. Reads the schema only, not the data."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return literal_rows(df.sparkSession, rows, "column_name string, data_type string")
