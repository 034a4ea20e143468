"""Cleaning, profiling and whole runs of a table from its spec."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import column, is_missing, literal_rows
from ..operators.outliers import outside_fence
from ..operators.quality import SUMMARY, outside_domain, summary_aggregates
from ..sources import materialize, scan_raw, scratch_scope, staged, write_curated
from .sizing import PARTITION_BYTES, sized_for
from .spec import TableSpec

COPIES = "__copies"
PREVIEW_ROWS = 5


def before_dedup(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The steps ahead of duplicate removal."""
    df = op.normalize_names(df)
    if spec.positional_names:
        df = op.rename_positional(df, spec.positional_names)
    df = op.trim_columns(df, spec.trim_cols)
    df = op.cast_columns(df, spec.casts)
    if spec.dedup_stage == "clean":
        df = _clean_text(df, spec)
    return df


def after_dedup(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The text steps behind duplicate removal."""
    return df if spec.dedup_stage == "clean" else _clean_text(df, spec)


def _clean_text(df: DataFrame, spec: TableSpec) -> DataFrame:
    df = op.blank_to_null(df, spec.blank_to_null_cols)
    return op.standardize_text(df, spec.text_cols)


def clean_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Everything but the outlier policy."""
    return after_dedup(op.drop_duplicate_rows(before_dedup(df, spec)), spec)


def clean_with_copies(df: DataFrame, spec: TableSpec) -> DataFrame:
    """:func:`clean_rows` plus how many raw rows each curated row stands for.

    One grouping serves the curated table, the duplicate report and the reports on the rows as
    they were before duplicate removal.
    """
    return after_dedup(op.count_copies(before_dedup(df, spec), COPIES), spec)


def apply_outlier_policy(
    df: DataFrame,
    spec: TableSpec,
    rel_err: float = 0.01,
    limits: Mapping[str, op.Fence] | None = None,
) -> DataFrame:
    """Null the outliers where the spec says so."""
    if spec.outlier_policy != "null":
        return df
    return op.null_outliers(df, spec.outlier_cols, rel_err=rel_err, limits=limits)


def clean_table(df: DataFrame, spec: TableSpec, rel_err: float = 0.01) -> DataFrame:
    """The curated form of a raw table.

    With the default ``rel_err`` the fences are a subquery that reuses the shuffle of the
    duplicate removal: one scan, one wide shuffle. Exact fences need several scans, so the cleaned
    rows are stored as a scratch table first and the plan goes on from there.
    """
    rows = clean_rows(df, spec)
    if spec.outlier_policy == "null" and op.exact(rel_err):
        rows = materialize(rows, spec.name)
    return apply_outlier_policy(rows, spec, rel_err)


def profile_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All count and summary reports of a raw table: column_name, metric, value (double).

    Column name ``*`` marks metrics of the whole table. The two aggregates share one scan and one
    shuffle.
    """
    return profile_cleaned(clean_with_copies(df, spec), spec)


def profile_cleaned(
    counted: DataFrame, spec: TableSpec, values: DataFrame | None = None
) -> DataFrame:
    """:func:`profile_table` of rows from :func:`clean_with_copies`.

    ``values`` takes a stored :func:`value_report`, which already holds the distinct values.
    """
    summary = _summary_profile(counted, spec)
    if not spec.distinct_cols:
        return summary
    if values is None:
        # Copies are always positive. Testing them keeps the grouping below the same as in the
        # summary, so that one shuffle feeds both; unused, the count would be optimised away here.
        values = op.value_counts(counted.filter(F.col(COPIES) > 0), spec.distinct_cols)
    return summary.unionByName(_distinct_profile(values, spec))


def _summary_profile(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """Counts, missing values and descriptive statistics: one aggregate, no shuffle of rows."""
    columns = [c for c in counted.columns if c != COPIES]
    lengths = {f"{c}_length": F.length(column(c)) for c in spec.length_cols}
    counted = counted.withColumns(lengths)
    described = [*spec.describe_cols, *lengths]
    weighted = spec.missing_stage == "before_dedup"

    def missing(c: str) -> Column:
        test = is_missing(counted, c) if spec.missing_test == "null_or_blank" else column(c).isNull()
        if weighted:
            return F.coalesce(F.sum(F.when(test, F.col(COPIES)).otherwise(0)), F.lit(0))
        return F.count_if(test)

    wide = counted.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("before"),
        F.count(F.lit(1)).alias("after"),
        *[missing(c).alias(f"missing_{i}") for i, c in enumerate(columns)],
        *[
            aggregate.alias(f"{part}_{i}")
            for i, c in enumerate(described)
            for part, aggregate in summary_aggregates(counted, c).items()
        ],
    )
    out = [
        ("*", "rows_before", "before"),
        ("*", "rows_after", "after"),
        ("*", "duplicates_removed", "before - after"),
    ]
    rows = "before" if weighted else "after"
    for i, c in enumerate(columns):
        out.append((c, "missing_count", f"missing_{i}"))
        if spec.missing_ratio:
            out.append((c, "missing_ratio", f"try_divide(missing_{i}, {rows})"))
    for i, c in enumerate(described):
        out += [(c, part, f"{part}_{i}") for part in SUMMARY]
    return wide.select(F.expr(_stack(out)).alias("column_name", "metric", "value"))


def _stack(metrics: list[tuple[str, str, str]]) -> str:
    """SQL that turns one wide row into a row (column_name, metric, value) per metric."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    cells = [f"{quoted(c)}, '{m}', CAST({value} AS DOUBLE)" for c, m, value in metrics]
    return f"stack({len(cells)}, {', '.join(cells)})"


def _distinct_profile(values: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct counts and their share of the rows, all columns from one grouping."""
    none = [(c, None, 0) for c in spec.distinct_cols]  # a row each, also for an empty table
    schema = "column_name string, value string, rows bigint"
    per_column = (
        values.filter(F.col("column_name").isin(*spec.distinct_cols))
        .unionByName(literal_rows(values.sparkSession, none, schema))
        .groupBy("column_name")
        .agg(F.count("value").alias("distinct_count"), F.sum("rows").alias("rows"))
    )
    out = [("distinct_count", F.col("distinct_count"))]
    if spec.distinct_ratio:
        out.append(("cardinality_ratio", F.try_divide(F.col("distinct_count"), F.col("rows"))))
    wide = per_column.select("column_name", *[v.cast("double").alias(m) for m, v in out])
    return wide.unpivot("column_name", [m for m, _ in out], "metric", "value")


def value_report(cleaned: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct values and frequencies of all listed columns: column_name, value, rows."""
    return op.value_counts(cleaned, list(dict.fromkeys([*spec.distinct_cols, *spec.frequency_cols])))


def flagged_rows(
    cleaned: DataFrame,
    spec: TableSpec,
    rel_err: float = 0.01,
    limits: Mapping[str, op.Fence] | None = None,
) -> DataFrame:
    """Every outlier, non-positive value and domain violation in one scan.

    Columns ``check`` (outlier, non_positive, domain) and ``column_name`` come before the row; a
    row that fails several checks is listed for each. Where outliers are replaced by null, a row
    is shown with the columns handled earlier already replaced.
    """
    outside = {}
    if spec.outlier_cols:
        outside = outside_fence(cleaned, spec.outlier_cols, 1.5, rel_err, limits)
    as_is = {c: column(c) for c in cleaned.columns}
    listed = []
    row = dict(as_is)
    for c, test in outside.items():
        listed.append(("outlier", c, test, dict(row)))
        if spec.outlier_policy == "null":
            row[c] = F.when(test, None).otherwise(column(c))
    for c in spec.non_positive_cols:
        listed.append(("non_positive", c, column(c) <= 0, as_is))
    for c, allowed in spec.domains.items():
        listed.append(("domain", c, outside_domain(cleaned, c, allowed), as_is))
    if not listed:
        labels = [F.lit("").alias("check"), F.lit("").alias("column_name")]
        return cleaned.select(*labels, "*").filter(F.lit(False))
    hits = [
        F.when(
            test,
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column_name"),
                *[value.alias(name) for name, value in shown.items()],
            ),
        )
        for check, column, test, shown in listed
    ]
    failing = cleaned.filter(reduce(or_, [test for _, _, test, _ in listed]))
    return failing.select(F.inline(F.array_compact(F.array(*hits))))


def detail_reports(
    cleaned: DataFrame,
    spec: TableSpec,
    rel_err: float = 0.01,
    limits: Mapping[str, op.Fence] | None = None,
) -> dict[str, DataFrame]:
    """Each listing of a table as a lazy frame of its own; ``cleaned`` is from :func:`clean_rows`.

    For all of them at once, :func:`value_report` and :func:`flagged_rows` take one scan each.
    """
    out = {"schema": op.schema_report(cleaned)}
    for c in spec.distinct_cols:
        out[f"distinct_{c}"] = op.distinct_values(cleaned, c)
    for c in spec.frequency_cols:
        out[f"frequency_{c}"] = op.frequency(cleaned, c)
    for c, allowed in spec.domains.items():
        out[f"domain_{c}"] = op.domain_violations(cleaned, c, allowed)
    if limits is None and spec.outlier_cols and op.exact(rel_err):
        limits = op.fences(cleaned, spec.outlier_cols, rel_err=rel_err)
    frame = cleaned
    for c in spec.outlier_cols:
        out[f"outliers_{c}"] = op.iqr_outliers(frame, c, rel_err=rel_err, limits=limits)
        if spec.outlier_policy == "null":
            frame = op.null_outliers(frame, [c], rel_err=rel_err, limits=limits)
    for c in spec.non_positive_cols:
        out[f"non_positive_{c}"] = op.non_positive(cleaned, c)
    if spec.sample_cols:
        out["sample"] = op.sample_values(cleaned, spec.sample_cols)
    return out


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    raw: str | list[str],
    curated: str,
    reports: str | None = None,
    rel_err: float = 0.01,
    on_bad_value: str = "error",
    multiline: bool | None = None,
    partition_bytes: int = PARTITION_BYTES,
    split_bytes: int | None = None,
) -> DataFrame:
    """Raw CSV to curated Parquet; returns the curated table.

    ``multiline`` overrides the spec's. ``partition_bytes`` of raw
    input make a shuffle partition and ``split_bytes`` a scan split (None: the session's setting).
    ``on_bad_value`` is that of :func:`read_raw`.

    The CSV is parsed once. Unless all types are declared and no reports are asked for, its fields are stored as
    text; types are counted and rows are read there. Without reports, and unless exact fences are
    asked for, the rest is one lazy plan: one scan, one wide shuffle, one write.

    With ``reports`` the rows are shuffled once, into a scratch table
    of cleaned rows with their copy counts. Everything else is a narrow scan of that table, and its
    stored files stand between the heavy shuffle and the jobs that follow. Fences are found once,
    so the listings agree with the values that were replaced. The reports are ``preview`` (the first five
    rows as read, in file order), ``raw_columns`` (names and types as read), ``profile``,
    ``values`` (distinct values and frequencies), ``flagged`` (outliers, non-positive values,
    domain violations), ``schema`` and ``sample``, and with ``on_bad_value="drop"`` ``bad_records``.

    All scratch tables are removed at the end.
    """
    nulling = spec.outlier_policy == "null"
    with sized_for(spark, raw, partition_bytes, split_bytes), scratch_scope(spark):
        scan = scan_raw(
            spark,
            raw,
            spec.types,
            multiline=spec.multiline if multiline is None else multiline,
            infer_rest=spec.infer_rest,
            store=bool(reports),
        )
        if scan is None:
            raise ValueError(f"no header line in {raw}")
        source = scan.rows(on_bad_value)
        schema = clean_rows(source, spec).schema
        if reports:
            write_curated(scan.preview(PREVIEW_ROWS, on_bad_value), f"{reports}/preview")
            write_curated(op.schema_report(source), f"{reports}/raw_columns")
            if on_bad_value == "drop":
                write_curated(scan.bad_records(), f"{reports}/bad_records")
        if not reports and not (nulling and op.exact(rel_err)):
            write_curated(clean_table(source, spec, rel_err), curated)
        else:
            with staged(clean_with_copies(source, spec), spec.name) as counted:
                rows = counted.drop(COPIES)
                limits = op.fences(rows, spec.outlier_cols, rel_err=rel_err)
                write_curated(apply_outlier_policy(rows, spec, limits=limits), curated)
                if reports:
                    _write_reports(counted, spec, limits, reports)
    return spark.read.schema(schema).parquet(curated)


def _write_reports(
    counted: DataFrame, spec: TableSpec, limits: Mapping[str, op.Fence] | None, path: str
) -> None:
    rows = counted.drop(COPIES)
    values = None
    if spec.distinct_cols or spec.frequency_cols:
        report = value_report(rows, spec)
        write_curated(report, f"{path}/values")
        values = counted.sparkSession.read.schema(report.schema).parquet(f"{path}/values")
    write_curated(profile_cleaned(counted, spec, values), f"{path}/profile")
    if spec.outlier_cols or spec.non_positive_cols or spec.domains:
        write_curated(flagged_rows(rows, spec, limits=limits), f"{path}/flagged")
    write_curated(op.schema_report(rows), f"{path}/schema")
    if spec.sample_cols:
        write_curated(op.sample_values(rows, spec.sample_cols), f"{path}/sample")
