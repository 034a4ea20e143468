"""Operators over DataFrames: DataFrame in, DataFrame out, nothing but built-in expressions."""

from .dedup import count_copies, drop_duplicate_rows, duplicate_report
from .distinct import distinct_sketches, frequent_values, merge_distinct_sketches
from .hashed_dedup import drop_duplicate_wide_rows, drop_duplicates_by
from .names import normalize_names, normalized_name, rename_positional, schema_report
from .outliers import FINEST_SKETCH, Fence, exact, fences, iqr_outliers, null_outliers, quantile_bounds
from .quality import (
    cardinality_ratio,
    cardinality_ratios,
    describe_columns,
    distinct_counts,
    distinct_values,
    domain_violations,
    frequency,
    missing_counts,
    missing_ratios,
    non_positive,
    null_counts,
    preview,
    row_count,
    sample_values,
    text_length_stats,
    value_counts,
)
from .quantiles import exact_quantiles
from .ranks import quartile_ranks
from .text import blank_to_null, cast_columns, standardize_text, trim_columns

__all__ = [
    "FINEST_SKETCH",
    "exact",
    "Fence",
    "blank_to_null",
    "cardinality_ratio",
    "cardinality_ratios",
    "cast_columns",
    "count_copies",
    "describe_columns",
    "distinct_counts",
    "distinct_sketches",
    "distinct_values",
    "domain_violations",
    "drop_duplicate_rows",
    "drop_duplicate_wide_rows",
    "drop_duplicates_by",
    "duplicate_report",
    "exact_quantiles",
    "fences",
    "frequency",
    "frequent_values",
    "iqr_outliers",
    "merge_distinct_sketches",
    "missing_counts",
    "missing_ratios",
    "non_positive",
    "normalize_names",
    "normalized_name",
    "null_counts",
    "null_outliers",
    "preview",
    "quantile_bounds",
    "quartile_ranks",
    "rename_positional",
    "row_count",
    "sample_values",
    "schema_report",
    "standardize_text",
    "text_length_stats",
    "trim_columns",
    "value_counts",
]
