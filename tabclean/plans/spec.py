"""What to do with a table, as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """Cleaning and reporting rules of one table; step order is part of the result.

    ``dedup_stage`` says on which form duplicates are removed: ``"raw"`` before any cleaning,
    ``"trimmed"`` after trimming only, ``"clean"`` after all text cleaning. ``types`` holds the
    columns of known type, as a rule ids and text; ``"numeric"`` is a number of the type that the data tell,
    and with ``infer_rest`` the data tell all about the others.
    """

    name: str
    # reading
    types: Mapping[str, str] = field(default_factory=dict)
    infer_rest: bool = True
    multiline: bool = False
    # cleaning
    positional_names: tuple[str, ...] = ()
    trim_cols: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    text_cols: tuple[str, ...] = ()
    dedup_stage: str = "clean"
    blank_to_null_cols: tuple[str, ...] = ()
    outlier_cols: tuple[str, ...] = ()
    outlier_policy: str = "report"
    # reporting
    missing_test: str = "null_or_blank"
    missing_stage: str = "before_dedup"
    missing_ratio: bool = True
    distinct_cols: tuple[str, ...] = ()
    distinct_ratio: bool = True
    describe_cols: tuple[str, ...] = ()
    length_cols: tuple[str, ...] = ()
    frequency_cols: tuple[str, ...] = ()
    domains: Mapping[str, tuple] = field(default_factory=dict)
    non_positive_cols: tuple[str, ...] = ()
    sample_cols: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name, value, options in (
            ("dedup_stage", self.dedup_stage, ("raw", "trimmed", "clean")),
            ("outlier_policy", self.outlier_policy, ("report", "null")),
            ("missing_test", self.missing_test, ("null", "null_or_blank")),
            ("missing_stage", self.missing_stage, ("before_dedup", "after_dedup")),
        ):
            if value not in options:
                raise ValueError(f"{name} must be one of {options}, not {value!r}")
