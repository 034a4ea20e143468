"""Cleaning and quality profiling of tables with Spark DataFrames."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans import (
    TABLES,
    TableSpec,
    clean_table,
    detail_reports,
    flagged_rows,
    profile_table,
    run_table,
    value_report,
)
from .sources import materialize, read_raw, scan_raw, scratch_scope, type_report, write_curated

__all__ = [
    *_operators,
    "TABLES",
    "TableSpec",
    "clean_table",
    "detail_reports",
    "flagged_rows",
    "materialize",
    "profile_table",
    "read_raw",
    "run_table",
    "scan_raw",
    "scratch_scope",
    "type_report",
    "value_report",
    "write_curated",
]
