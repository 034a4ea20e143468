"""Reading raw files, writing curated tables, and shared scratch tables."""

from .curated import write_curated
from .inference import type_report
from .raw import RawScan, read_raw, scan_raw
from .scratch import materialize, scratch_root, scratch_scope, staged

__all__ = [
    "RawScan",
    "materialize",
    "read_raw",
    "scan_raw",
    "scratch_root",
    "scratch_scope",
    "staged",
    "type_report",
    "write_curated",
]
