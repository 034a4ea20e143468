"""Every operator and job as a query over whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tabclean as tc
from tabclean.plans import clean_rows, detail_reports, run_table
from tabclean.sources import scan_raw
from tabclean.sources.scratch import scratch_path

from . import inputs

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for name in inputs.TABLE_NAMES:
        if name in text:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, inputs.DIRTY)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def messy_headers(df: DataFrame) -> DataFrame:
    """The headers a person would type: capitals, inner spaces, padding."""
    return df.toDF(*[f" {c.replace('_', ' ').title()} " for c in df.columns])


def as_csv(df: DataFrame, name: str) -> str:
    """Write CSV with padding kept, in the shared scratch folder."""
    path = scratch_path(df.sparkSession, name)
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


# Sources, sinks, names


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_csv(messy_headers(table(spark, sf_dir, "customer")), "csv_scan")
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    return tc.normalize_names(tc.read_raw(spark, path, types=types))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_csv(table(spark, sf_dir, "part"), "csv_scan_inferred")
    return tc.cast_columns(tc.read_raw(spark, path), {"p_partkey": "bigint"})


def csv_scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_csv(table(spark, sf_dir, "documents"), "csv_scan_multiline")
    return tc.read_raw(spark, path, types={"doc_id": "bigint", "n_chars": "bigint"}, multiline=True)


def csv_scan_quoted(spark: SparkSession, sf_dir: str, multiline: bool) -> DataFrame:
    """Doubled quotes with commas after them, a count column written with a decimal point, and an
    undeclared column that holds 1 in some rows and 1.0 in others."""
    rows = from_sql(spark, sf_dir, inputs.QUOTED)
    path = as_csv(rows, "csv_scan_quoted")
    types = {"c_custkey": "bigint", "note": "string"}
    read = tc.read_raw(spark, path, types=types, multiline=multiline, infer_rest=True)
    return tc.drop_duplicate_rows(read)


def csv_records(spark: SparkSession, sf_dir: str) -> str:
    """A file whose lines are not all good, written as they are."""
    path = scratch_path(spark, "csv_records")
    lines = from_sql(spark, sf_dir, inputs.RECORDS)
    lines.toDF("key,segment,nation").write.options(header=True, sep="\x01", quote="", escape="").csv(path)
    return path


def csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with surplus fields or a value not of its type, told apart from good ones."""
    scan = scan_raw(spark, csv_records(spark, sf_dir), {"key": "bigint", "nation": "int"})
    return scan.bad_records().select("record", "reason")


def csv_good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left without them."""
    types = {"key": "bigint", "nation": "int"}
    return tc.read_raw(spark, csv_records(spark, sf_dir), types=types, on_bad_value="drop")


def csv_column_of_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted without reading a column, and by one column only: both without the bad ones."""
    types = {"key": "bigint", "nation": "int"}
    rows = tc.read_raw(spark, csv_records(spark, sf_dir), types=types, on_bad_value="drop")
    segments = rows.select("segment").agg(F.count("segment").alias("rows"))
    return tc.row_count(rows).toDF("rows").unionByName(segments)


def csv_type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_csv(from_sql(spark, sf_dir, inputs.TYPED), "csv_type_report")
    return tc.type_report(tc.read_raw(spark, path, types={}))


def csv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows in file order; the files are written in the order of the key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = as_csv(orders.orderBy("o_orderkey"), "csv_preview")
    return scan_raw(spark, path, {"o_orderkey": "bigint", "o_custkey": "bigint"}).preview(5)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet_roundtrip")
    tc.write_curated(table(spark, sf_dir, "part"), path)
    return spark.read.parquet(path)


def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet_partitioned")
    tc.write_curated(table(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a CSV scan: text columns and the key declared, the other types found in the data."""
    path = as_csv(table(spark, sf_dir, "customer"), "schema_report")
    types = {"c_custkey": "bigint", "c_name": "string", "c_mktsegment": "string"}
    return tc.schema_report(tc.read_raw(spark, path, types=types, infer_rest=True))


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").toDF(
        "\tC Cust Key ", "C Name", " C NATION KEY", "c_acctbal", "C mkt Segment "
    )
    return tc.normalize_names(df)


def rename_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.rename_positional(
        table(spark, sf_dir, "conversations"), ["encounter_id", "note_no", "note_type"]
    )


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.preview(table(spark, sf_dir, "orders"), 5, order_by="o_orderkey")


def sample_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return tc.sample_values(orders, ["o_totalprice", "o_orderstatus"], 5, order_by="o_orderkey")


# Cleaning


def trim_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.trim_columns(dirty(spark, sf_dir), ["seg"])


def standardize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.standardize_text(dirty(spark, sf_dir), ["seg"])


def standardize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.standardize_text(table(spark, sf_dir, "documents"), ["text", "source"])


def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.blank_to_null(dirty(spark, sf_dir), ["seg"])


def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.cast_columns(dirty(spark, sf_dir), {"c_custkey": "string", "flag": "bigint"})


def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.drop_duplicate_rows(dirty(spark, sf_dir))


def drop_duplicate_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.drop_duplicate_rows(table(spark, sf_dir, "conversations"))


def drop_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.drop_duplicate_rows(table(spark, sf_dir, "documents").drop("doc_id"))


def drop_duplicate_documents_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.drop_duplicate_wide_rows(table(spark, sf_dir, "documents").drop("doc_id"))


def first_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first turn of each role in each conversation."""
    turns = table(spark, sf_dir, "conversations")
    return tc.drop_duplicates_by(turns, ["conv_id", "role"], ["turn", "text"])


def count_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.count_copies(tc.standardize_text(dirty(spark, sf_dir), ["seg"]))


def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.duplicate_report(dirty(spark, sf_dir))


# Quality


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.row_count(dirty(spark, sf_dir))


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.null_counts(dirty(spark, sf_dir))


def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.missing_counts(dirty(spark, sf_dir))


def missing_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.missing_ratios(dirty(spark, sf_dir))


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.distinct_values(dirty(spark, sf_dir), "seg")


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.distinct_counts(dirty(spark, sf_dir), ["c_custkey", "seg", "flag"])


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def distinct_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.distinct_counts(table(spark, sf_dir, "lineitem"), LINEITEM_COLS)


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored for each flag and merged; whether they are as near to the true counts as stated."""
    lines = table(spark, sf_dir, "lineitem")
    stored = tc.materialize(tc.distinct_sketches(lines, LINEITEM_COLS, ["l_returnflag"]), "distinct-sketches")
    guessed = tc.merge_distinct_sketches(stored, LINEITEM_COLS).drop("rows")
    guessed = guessed.toDF(*[f"{c}_guess" for c in LINEITEM_COLS])
    both = tc.distinct_counts(lines, LINEITEM_COLS).crossJoin(guessed)  # a row each
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}_distinct").alias("distinct_count"),
            (F.abs(F.col(f"{c}_guess") - F.col(f"{c}_distinct")) <= 0.03 * F.col(f"{c}_distinct")).alias("within"),
        )
        for c in LINEITEM_COLS
    ]
    return both.select(F.inline(F.array(*rows)))


def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    return tc.frequent_values(table(spark, sf_dir, "lineitem"), cols, share=0.0005)


def frequent_values_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.frequent_values(table(spark, sf_dir, "events"), ["user_id", "event_type", "value"], share=0.001)


def cardinality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.cardinality_ratio(dirty(spark, sf_dir), "seg")


def cardinality_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.cardinality_ratios(dirty(spark, sf_dir), ["c_custkey", "seg", "flag"])


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.value_counts(dirty(spark, sf_dir), ["seg", "flag"])


def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tc.describe_columns(dirty(spark, sf_dir), ["bal", "flag"]), "mean", "stddev")


def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tc.text_length_stats(table(spark, sf_dir, "documents"), "text")
    return rounded(stats, "mean", "stddev")


def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.frequency(dirty(spark, sf_dir), "flag")


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.domain_violations(dirty(spark, sf_dir), "flag", (0, 1))


def non_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.non_positive(dirty(spark, sf_dir), "bal")


# Outliers, with exact quartiles


def quantile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return rounded(
        tc.quantile_bounds(events, ["value", "user_id"], rel_err=0), "lower_bound", "upper_bound"
    )


def quantile_bounds_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    bounds = tc.quantile_bounds(table(spark, sf_dir, "lineitem"), cols, rel_err=0)
    return rounded(bounds, "lower_bound", "upper_bound")


def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.iqr_outliers(dirty(spark, sf_dir), "bal", rel_err=0)


def iqr_outliers_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.iqr_outliers(table(spark, sf_dir, "events"), "value", rel_err=0)


def iqr_outliers_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.iqr_outliers(table(spark, sf_dir, "documents"), "n_chars", rel_err=0)


def null_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.null_outliers(dirty(spark, sf_dir), ["bal"], rel_err=0)


def null_outliers_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.null_outliers(table(spark, sf_dir, "events"), ["value", "user_id"], rel_err=0)


# Outliers, with the default rank error


def quartile_ranks_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether sketched quartiles hold their rank error, by counting true ranks."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ranks = tc.quartile_ranks(table(spark, sf_dir, "lineitem"), cols, rel_err=0.01)
    return ranks.select("column_name", "quartile", "rows", "within")


def quartile_ranks_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the cleaned encounters, whose outliers follow from them."""
    spec = tc.TABLES["encounters"]
    rows = clean_rows(raw_table(spark, sf_dir, "encounters"), spec)
    ranks = tc.quartile_ranks(rows, spec.outlier_cols, rel_err=0.01)
    return ranks.select("column_name", "quartile", "rows", "within")


def run_encounters_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run with the default rank error: all columns that no fence touches."""
    spec = tc.TABLES["encounters"]
    raw = as_csv(raw_table(spark, sf_dir, "encounters"), "raw_encounters")
    curated = run_table(spark, spec, raw, scratch_path(spark, "run_encounters_default"))
    return curated.drop(*spec.outlier_cols)


# Table jobs


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return messy_headers(from_sql(spark, sf_dir, inputs.RAW[name]))


def job(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.clean_table(raw_table(spark, sf_dir, name), tc.TABLES[name], rel_err=0)


def profile(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tc.profile_table(raw_table(spark, sf_dir, name), tc.TABLES[name]), "value")


def listing(name: str, report: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tc.TABLES[name]
    rows = clean_rows(raw_table(spark, sf_dir, name), spec)
    if not report.startswith("outliers_"):
        return detail_reports(rows, spec)[report]
    return detail_reports(tc.materialize(rows, name), spec, rel_err=0)[report]


def flagged(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tc.TABLES[name]
    rows = tc.materialize(clean_rows(raw_table(spark, sf_dir, name), spec), name)
    return tc.flagged_rows(rows, spec, rel_err=0)


def run_report(name: str, report: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that a whole run writes."""
    raw = as_csv(raw_table(spark, sf_dir, name), f"raw_{name}")
    out = scratch_path(spark, f"run_{name}")
    run_table(spark, tc.TABLES[name], raw, f"{out}/curated", f"{out}/reports", rel_err=0)
    found = spark.read.parquet(f"{out}/reports/{report}")
    return rounded(found, "value") if report == "profile" else found


def values(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tc.TABLES[name]
    return tc.value_report(clean_rows(raw_table(spark, sf_dir, name), spec), spec)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to curated Parquet with all reports, then the curated table."""
    raw = as_csv(raw_table(spark, sf_dir, name), f"raw_{name}")
    out = scratch_path(spark, f"run_{name}")
    return run_table(
        spark, tc.TABLES[name], raw, f"{out}/curated", f"{out}/reports", rel_err=0
    )


SHORT = {
    "notes": "clinical_notes",
    "encounters": "encounters",
    "facilities": "facilities",
    "medications": "medications",
    "patients": "patients",
    "labs": "vital_labs",
}


def all_queries() -> dict[str, Query]:
    plain = [
        csv_scan, csv_scan_inferred, csv_scan_multiline, csv_bad_records, csv_good_records,
        csv_column_of_bad_file, csv_type_report, csv_preview, parquet_roundtrip, parquet_partitioned,
        schema_report, normalize_names, rename_positional, preview, sample_values,
        trim_columns, standardize_text, standardize_documents, blank_to_null, cast_columns,
        drop_duplicate_rows, drop_duplicate_turns, drop_duplicate_documents, drop_duplicate_documents_hashed,
        first_turns, count_copies, duplicate_report, quartile_ranks_lineitem, quartile_ranks_encounters,
        run_encounters_default,
        row_count, null_counts, missing_counts, missing_ratios,
        distinct_values, distinct_counts, distinct_counts_lineitem, distinct_sketches, frequent_values,
        frequent_values_events, cardinality_ratio, cardinality_ratios, value_counts,
        describe_columns, text_length_stats, frequency, domain_violations, non_positive,
        quantile_bounds, quantile_bounds_lineitem,
        iqr_outliers, iqr_outliers_events, iqr_outliers_documents,
        null_outliers, null_outliers_events,
    ]
    out: dict[str, Query] = {f.__name__: f for f in plain}
    out["csv_scan_quoted"] = partial(csv_scan_quoted, multiline=False)
    out["csv_scan_quoted_multiline"] = partial(csv_scan_quoted, multiline=True)
    for short, name in SHORT.items():
        out[f"job_{short}"] = partial(job, name)
        out[f"profile_{short}"] = partial(profile, name)
        out[f"values_{short}"] = partial(values, name)
        out[f"run_{short}"] = partial(run, name)
    for short in ("encounters", "facilities", "patients", "labs"):
        out[f"flagged_{short}"] = partial(flagged, SHORT[short])
    for report in ("profile", "values", "flagged", "raw_columns"):
        out[f"run_facilities_{report}"] = partial(run_report, "facilities", report)
    out["listing_encounters_outliers"] = partial(listing, "encounters", "outliers_encounter_severity")
    out["listing_facilities_outliers"] = partial(listing, "facilities", "outliers_bed_count")
    out["listing_facilities_domain"] = partial(listing, "facilities", "domain_teaching_hospital")
    out["listing_labs_non_positive"] = partial(listing, "vital_labs", "non_positive_glucose_mg_dl")
    out["listing_patients_distinct"] = partial(listing, "patients", "distinct_ethnicity")
    return out
