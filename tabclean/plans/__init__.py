"""Table specs and the jobs built from them."""

from .jobs import (
    clean_rows,
    clean_table,
    clean_with_copies,
    detail_reports,
    flagged_rows,
    profile_cleaned,
    profile_table,
    run_table,
    value_report,
)
from .sizing import input_bytes, size_settings, sized_for
from .spec import TableSpec
from .tables import (
    ENCOUNTERS,
    FACILITIES,
    MEDICATIONS,
    NOTES,
    PATIENTS,
    TABLES,
    VITAL_LABS,
)

__all__ = [
    "ENCOUNTERS",
    "FACILITIES",
    "MEDICATIONS",
    "NOTES",
    "PATIENTS",
    "TABLES",
    "VITAL_LABS",
    "TableSpec",
    "clean_rows",
    "clean_table",
    "clean_with_copies",
    "detail_reports",
    "flagged_rows",
    "input_bytes",
    "profile_cleaned",
    "profile_table",
    "run_table",
    "size_settings",
    "sized_for",
    "value_report",
]
