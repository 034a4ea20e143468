"""Column expressions shared by the operators."""

from .columns import (
    as_double,
    column,
    is_blank,
    is_missing,
    literal_rows,
    quoted,
    standardized,
    trimmed,
)

__all__ = [
    "as_double",
    "column",
    "is_blank",
    "is_missing",
    "literal_rows",
    "quoted",
    "standardized",
    "trimmed",
]
