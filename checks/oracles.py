"""The same results in plain SQL, written from the rules and not from the library."""

from __future__ import annotations

from . import inputs

D = f"({inputs.DIRTY})"


def quartiles(table: str, col: str) -> str:
    """One row q1, q3 with the values at ranks ceil(n/4) and ceil(3n/4)."""
    return (
        f"SELECT CAST(q[1] AS DOUBLE) AS q1, CAST(q[2] AS DOUBLE) AS q3 "
        f"FROM (SELECT quantile_disc({col}, [0.25, 0.75]) AS q FROM {table})"
    )


def outlier(col: str) -> str:
    return f"({col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1))"


def bounds_row(table: str, col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, q1, q3, "
        f"round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound "
        f"FROM ({quartiles(table, col)})"
    )


def describe_row(table: str, expr: str, name: str, extreme: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count({expr}) AS count, "
        f"round(avg({expr}), 4) AS mean, round(stddev_samp({expr}), 4) AS stddev, "
        f"CAST(min({expr}) AS {extreme}) AS min, CAST(max({expr}) AS {extreme}) AS max FROM {table}"
    )


def null_count(col: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)"


def missing_count(col: str) -> str:
    return (
        f"CAST(coalesce(sum(CASE WHEN {col} IS NULL OR trim(CAST({col} AS VARCHAR), ' ') = '' "
        f"THEN 1 ELSE 0 END), 0) AS BIGINT)"
    )


DIRTY_COLUMNS = ("c_custkey", "seg", "bal", "flag")


def each(template, cols) -> str:
    return ", ".join(template(c) for c in cols)


BAD_RECORD = "value LIKE '%,EXTRA' OR value LIKE '%,' OR value LIKE '%,N/A'"

LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")

OPERATORS = {
    "csv_scan": "SELECT * FROM customer",
    "csv_scan_inferred": "SELECT * FROM part",
    "csv_scan_multiline": "SELECT * FROM documents",
    **dict.fromkeys(("csv_scan_quoted", "csv_scan_quoted_multiline"), """
        SELECT c_custkey, 'he said "' || c_mktsegment || '", then left' AS note,
               CAST(3 AS DOUBLE) AS severity, CASE WHEN c_custkey % 3 = 0 THEN 2.5::DOUBLE ELSE 1::DOUBLE END AS dose
        FROM customer
    """),
    "parquet_roundtrip": "SELECT * FROM part",
    "parquet_partitioned": "SELECT * FROM orders",
    "csv_bad_records": f"""
        SELECT value AS record,
               CASE WHEN value LIKE '%N/A' THEN 'column nation: not of type int: N/A'
                    ELSE 'more than 3 fields: ' || value END AS reason
        FROM ({inputs.RECORDS}) WHERE {BAD_RECORD}""",
    "csv_good_records": f"""
        SELECT CAST(split_part(value, ',', 1) AS BIGINT) AS key, split_part(value, ',', 2) AS segment,
               CAST(nullif(split_part(value, ',', 3), '') AS INTEGER) AS nation
        FROM ({inputs.RECORDS}) WHERE NOT ({BAD_RECORD})""",
    "csv_column_of_bad_file": f"""
        SELECT count(*) AS rows FROM ({inputs.RECORDS}), (VALUES (1), (2)) AS way(n)
        WHERE NOT ({BAD_RECORD}) GROUP BY n""",
    "csv_type_report": f"""
        WITH found AS (
            SELECT column_name, CASE WHEN regexp_full_match(value, '[0-9]{{1,9}}') THEN 'int'
                       WHEN regexp_full_match(value, '[0-9]+') THEN 'bigint'
                       WHEN regexp_full_match(value, '[0-9]+[.][0-9]+') THEN 'double'
                       WHEN regexp_full_match(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date'
                       WHEN lower(value) IN ('true', 'false') THEN 'boolean'
                       ELSE 'string' END AS kind
            FROM (UNPIVOT ({inputs.TYPED}) ON COLUMNS(*) INTO NAME column_name VALUE value)
        ),
        takes(type, kind) AS (VALUES
            ('int', 'int'), ('bigint', 'int'), ('bigint', 'bigint'), ('decimal', 'int'), ('decimal', 'bigint'),
            ('double', 'int'), ('double', 'bigint'), ('double', 'double'), ('date', 'date'),
            ('timestamp', 'date'), ('boolean', 'boolean'), ('string', 'int'), ('string', 'bigint'),
            ('string', 'double'), ('string', 'date'), ('string', 'boolean'), ('string', 'string'))
        SELECT column_name, type,
               CAST(count(*) FILTER (WHERE NOT EXISTS (
                   FROM takes t WHERE t.type = types.type AND t.kind = found.kind)) AS BIGINT) AS resisting,
               type = map {{'a_key': 'int', 'b_long': 'bigint', 'c_number': 'double', 'd_mixed': 'string',
                            'e_flag': 'boolean', 'f_day': 'date', 'g_text': 'string'}}[column_name] AS fits
        FROM found, (SELECT DISTINCT type FROM takes) types
        GROUP BY column_name, type""",
    "csv_preview": """
        SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS position,
               o_orderkey, o_custkey, o_orderstatus
        FROM orders ORDER BY o_orderkey LIMIT 5""",
    "schema_report": """
        SELECT column_name,
               CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                                WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END AS data_type
        FROM (DESCRIBE customer)
    """,
    "normalize_names": """
        SELECT c_custkey AS c_cust_key, c_name, c_nationkey AS c_nation_key, c_acctbal,
               c_mktsegment AS c_mkt_segment
        FROM customer
    """,
    "rename_positional": """
        SELECT conv_id AS encounter_id, turn AS note_no, role AS note_type, text FROM conversations
    """,
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "sample_values": "SELECT o_totalprice, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
    "trim_columns": f"SELECT c_custkey, trim(seg, ' ') AS seg, bal, flag FROM {D}",
    "standardize_text": f"SELECT c_custkey, lower(trim(seg, ' ')) AS seg, bal, flag FROM {D}",
    "standardize_documents": """
        SELECT * REPLACE (lower(trim(text, ' ')) AS text, lower(trim(source, ' ')) AS source) FROM documents
    """,
    "blank_to_null": f"""
        SELECT c_custkey, CASE WHEN trim(seg, ' ') = '' THEN NULL ELSE seg END AS seg, bal, flag FROM {D}
    """,
    "cast_columns": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, seg, bal, CAST(flag AS BIGINT) AS flag FROM {D}
    """,
    "drop_duplicate_rows": f"SELECT DISTINCT * FROM {D}",
    "drop_duplicate_turns": "SELECT DISTINCT * FROM conversations",
    "drop_duplicate_documents": "SELECT DISTINCT * EXCLUDE (doc_id) FROM documents",
    "drop_duplicate_documents_hashed": "SELECT DISTINCT * EXCLUDE (doc_id) FROM documents",
    "first_turns": """
        SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (
            PARTITION BY conv_id, role ORDER BY turn NULLS FIRST, encode(text) NULLS FIRST) = 1
    """,
    "quartile_ranks_lineitem": """
        SELECT column_name, quartile, count(value) AS rows, true AS within
        FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
              ON COLUMNS(*) INTO NAME column_name VALUE value), (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) q(quartile)
        GROUP BY column_name, quartile
    """,
    "count_copies": f"""
        SELECT c_custkey, lower(trim(seg, ' ')) AS seg, bal, flag, count(*) AS copies
        FROM {D} GROUP BY 1, 2, 3, 4
    """,
    "duplicate_report": f"""
        SELECT (SELECT count(*) FROM {D}) AS rows_before,
               (SELECT count(*) FROM (SELECT DISTINCT * FROM {D})) AS rows_after,
               (SELECT count(*) FROM {D}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {D}))
                   AS duplicates_removed
    """,
    "row_count": f"SELECT count(*) AS row_count FROM {D}",
    "null_counts": f"SELECT {each(lambda c: f'{null_count(c)} AS {c}', DIRTY_COLUMNS)} FROM {D}",
    "missing_counts": f"SELECT {each(lambda c: f'{missing_count(c)} AS {c}', DIRTY_COLUMNS)} FROM {D}",
    "missing_ratios": f"""
        SELECT {each(lambda c: f'{missing_count(c)} / count(*) AS {c}', DIRTY_COLUMNS)} FROM {D}
    """,
    "distinct_values": f"SELECT DISTINCT seg FROM {D}",
    "distinct_counts_lineitem": "SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS {c}_distinct" for c in LINEITEM_COLS)
    + " FROM lineitem",
    "distinct_sketches": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, true AS within FROM lineitem"
        for c in LINEITEM_COLS
    ),
    "frequent_values": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS rows FROM lineitem GROUP BY {c} "
        "HAVING count(*) >= 0.0005 * (SELECT count(*) FROM lineitem)"
        for c in ("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    ),
    "frequent_values_events": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS rows FROM events GROUP BY {c} "
        "HAVING count(*) >= 0.001 * (SELECT count(*) FROM events)"
        for c in ("user_id", "event_type", "value")
    ),
    "distinct_counts": f"""
        SELECT count(DISTINCT c_custkey) AS c_custkey_distinct, count(DISTINCT seg) AS seg_distinct,
               count(DISTINCT flag) AS flag_distinct
        FROM {D}
    """,
    "cardinality_ratio": f"SELECT count(DISTINCT seg) / count(*) AS cardinality_ratio FROM {D}",
    "cardinality_ratios": f"""
        SELECT count(DISTINCT c_custkey) / count(*) AS c_custkey_ratio,
               count(DISTINCT seg) / count(*) AS seg_ratio,
               count(DISTINCT flag) / count(*) AS flag_ratio
        FROM {D}
    """,
    "value_counts": f"""
        SELECT 'seg' AS column_name, seg AS value, count(*) AS rows FROM {D} GROUP BY seg
        UNION ALL SELECT 'flag', CAST(flag AS VARCHAR), count(*) FROM {D} GROUP BY flag
    """,
    "describe_columns": f"""
        {describe_row(D, "bal", "bal", "DOUBLE")} UNION ALL {describe_row(D, "flag", "flag", "DOUBLE")}
    """,
    "text_length_stats": describe_row("documents", "length(text)", "text_length", "BIGINT"),
    "frequency": f"SELECT flag, count(*) AS count FROM {D} GROUP BY flag",
    "domain_violations": f"SELECT * FROM {D} WHERE flag NOT IN (0, 1)",
    "non_positive": f"SELECT * FROM {D} WHERE bal <= 0",
    "quantile_bounds": f"""
        {bounds_row("events", "value")} UNION ALL {bounds_row("events", "user_id")}
    """,
    "quantile_bounds_lineitem": " UNION ALL ".join(
        bounds_row("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "iqr_outliers": f"""
        SELECT d.* FROM {D} d, ({quartiles(D, "bal")}) WHERE {outlier("bal")}
    """,
    "iqr_outliers_events": f"""
        SELECT e.* FROM events e, ({quartiles("events", "value")}) WHERE {outlier("value")}
    """,
    "iqr_outliers_documents": f"""
        SELECT documents.* FROM documents, ({quartiles("documents", "n_chars")})
        WHERE {outlier("n_chars")}
    """,
    "null_outliers": f"""
        SELECT c_custkey, seg, CASE WHEN {outlier("bal")} THEN NULL ELSE bal END AS bal, flag
        FROM {D}, ({quartiles(D, "bal")})
    """,
    "null_outliers_events": f"""
        SELECT * EXCLUDE (u, v) REPLACE (CASE WHEN u THEN NULL ELSE user_id END AS user_id,
                                         CASE WHEN v THEN NULL ELSE value END AS value)
        FROM (SELECT events.*, {outlier("value")} AS v
              FROM events, ({quartiles("events", "value")})) a
        JOIN (SELECT event_id, {outlier("user_id")} AS u
              FROM events, ({quartiles("events", "user_id")})) b USING (event_id)
    """,
}


# Table jobs. Each rule set is written out as CTEs: src (raw), before (ahead of duplicate removal),
# rows (cleaned, without copies); step order follows the rules of each table.


def std(cols: str) -> dict[str, str]:
    return {c: f"lower(trim({c}, ' '))" for c in cols.split()}


def project(columns: str, replaced: dict[str, str]) -> str:
    return ", ".join(f"{replaced[c]} AS {c}" if c in replaced else c for c in columns.split())


COLUMNS = {
    "notes": "encounter_id note_type note_text",
    "encounters": (
        "encounter_id patient_id facility_id admission_type department primary_diagnosis_group "
        "discharge_disposition encounter_severity length_of_stay_days total_cost_usd "
        "adverse_outcome_flag readmitted_30_days_flag polypharmacy_flag opioid_prescribed_flag"
    ),
    "facilities": (
        "facility_id facility_name region bed_count teaching_hospital avg_patients_per_nurse"
    ),
    "medications": "encounter_id medication_class dose_no",
    "patients": (
        "patient_id gender ethnicity insurance_type socioeconomic_risk_level smoker_status age "
        "chronic_condition_count"
    ),
    "labs": (
        "encounter_id avg_heart_rate_bpm avg_systolic_bp glucose_mg_dl bmi abnormal_lab_count"
    ),
}

TEXT = {
    "notes": "note_type",
    "encounters": (
        "encounter_id patient_id facility_id admission_type department primary_diagnosis_group "
        "discharge_disposition"
    ),
    "facilities": "facility_id facility_name region",
    "medications": "encounter_id medication_class",
    "patients": (
        "patient_id gender ethnicity insurance_type socioeconomic_risk_level smoker_status"
    ),
    "labs": "encounter_id",
}

SOURCE = {
    "notes": inputs.NOTES,
    "encounters": inputs.ENCOUNTERS,
    "facilities": inputs.FACILITIES,
    "medications": inputs.MEDICATIONS,
    "patients": inputs.PATIENTS,
    "labs": inputs.VITAL_LABS,
}


def through_csv(short: str) -> str:
    """The raw rows as a CSV file holds them.

    An empty field and an empty text are both null; numbers keep the type they had.
    """
    read = {c: f"nullif({c}, '')" for c in TEXT[short].split()}
    if short == "notes":
        read |= {c: f"nullif({c}, '')" for c in ("encounter_id", "note_text")}
    return f"SELECT {project(COLUMNS[short], read)} FROM ({SOURCE[short]})"


def cleaned(short: str, source: str | None = None) -> str:
    """WITH clause that ends in a relation ``rows``."""
    cols = COLUMNS[short]
    head = f"WITH src AS ({source or SOURCE[short]}), "
    if short == "notes":
        trims = {c: f"trim({c}, ' ')" for c in cols.split()}
        blanks = {c: f"CASE WHEN trim({c}, ' ') = '' THEN NULL ELSE {c} END" for c in cols.split()}
        return (
            head
            + f"before AS (SELECT {project(cols, trims)} FROM src), "
            + "uniq AS (SELECT DISTINCT * FROM before), "
            + f"filled AS (SELECT {project(cols, blanks)} FROM uniq), "
            + f"rows AS (SELECT {project(cols, std(TEXT[short]))} FROM filled)"
        )
    if short == "encounters":
        return (
            head
            + "before AS (SELECT * FROM src), "
            + "uniq AS (SELECT DISTINCT * FROM before), "
            + f"rows AS (SELECT {project(cols, std(TEXT[short]))} FROM uniq)"
        )
    return (
        head
        + f"before AS (SELECT {project(cols, std(TEXT[short]))} FROM src), "
        + "rows AS (SELECT DISTINCT * FROM before)"
    )


ENCOUNTER_OUTLIERS = ("total_cost_usd", "length_of_stay_days", "encounter_severity")


def with_quartiles(cols) -> str:
    """``rows`` with q1_<col>, q3_<col> added for every column."""
    joins = ", ".join(
        f"(SELECT q1 AS q1_{c}, q3 AS q3_{c} FROM ({quartiles('rows', c)}))" for c in cols
    )
    return f"SELECT * FROM rows, {joins}"


def named_outlier(c: str) -> str:
    reach = f"1.5 * (q3_{c} - q1_{c})"
    return f"({c} < q1_{c} - {reach} OR {c} > q3_{c} + {reach})"


def job(short: str, source: str | None = None) -> str:
    if short != "encounters":
        return f"{cleaned(short, source)} SELECT * FROM rows"
    nulled = {c: f"CASE WHEN {named_outlier(c)} THEN NULL ELSE {c} END" for c in ENCOUNTER_OUTLIERS}
    return (
        f"{cleaned(short, source)} SELECT {project(COLUMNS[short], nulled)} "
        f"FROM ({with_quartiles(ENCOUNTER_OUTLIERS)})"
    )


def metric(column: str, name: str, value: str, table: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, '{name}' AS metric, "
        f"round(CAST({value} AS DOUBLE), 4) AS value FROM {table}"
    )


DESCRIBED = {
    "notes": [("length(note_text)", "note_text_length")],
    "encounters": [
        (c, c)
        for c in (
            "encounter_severity", "length_of_stay_days", "total_cost_usd", "adverse_outcome_flag",
            "readmitted_30_days_flag", "polypharmacy_flag", "opioid_prescribed_flag",
        )
    ],
    "facilities": [(c, c) for c in ("bed_count", "teaching_hospital", "avg_patients_per_nurse")],
    "medications": [],
    "patients": [(c, c) for c in ("age", "chronic_condition_count")],
    "labs": [],
}


def profile(short: str) -> str:
    late = short in ("notes", "encounters")  # missing values counted after duplicate removal
    missing_in = "rows" if late else "before"
    missing = null_count if short == "notes" else missing_count
    parts = [
        "SELECT '*' AS column_name, 'rows_before' AS metric, CAST(count(*) AS DOUBLE) AS value FROM before",
        "SELECT '*', 'rows_after', CAST(count(*) AS DOUBLE) FROM rows",
        "SELECT '*', 'duplicates_removed', "
        "CAST((SELECT count(*) FROM before) - (SELECT count(*) FROM rows) AS DOUBLE)",
    ]
    for c in COLUMNS[short].split():
        parts.append(metric(c, "missing_count", missing(c), missing_in))
        if not late:
            parts.append(metric(c, "missing_ratio", f"{missing(c)} / count(*)", missing_in))
    for expr, name in DESCRIBED[short]:
        parts += [
            metric(name, "count", f"count({expr})", "rows"),
            metric(name, "mean", f"avg({expr})", "rows"),
            metric(name, "stddev", f"stddev_samp({expr})", "rows"),
            metric(name, "min", f"min({expr})", "rows"),
            metric(name, "max", f"max({expr})", "rows"),
        ]
    for c in TEXT[short].split():
        parts.append(metric(c, "distinct_count", f"count(DISTINCT {c})", "rows"))
        if short != "notes":
            parts.append(metric(c, "cardinality_ratio", f"count(DISTINCT {c}) / count(*)", "rows"))
    return f"{cleaned(short)} " + " UNION ALL ".join(parts)


def values(short: str) -> str:
    """Distinct values and frequencies of the text columns, and of the facility flag."""
    cols = TEXT[short].split() + (["teaching_hospital"] if short == "facilities" else [])
    parts = [
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM rows GROUP BY {c}"
        for c in cols
    ]
    return f"{cleaned(short)} " + " UNION ALL ".join(parts)


FLAGGED = {
    "encounters": (ENCOUNTER_OUTLIERS, ()),
    "facilities": (("bed_count", "avg_patients_per_nurse"),) * 2,
    "patients": (("age", "chronic_condition_count"),) * 2,
    "labs": (
        ("avg_heart_rate_bpm", "avg_systolic_bp", "glucose_mg_dl", "bmi", "abnormal_lab_count"),
    ) * 2,
}


def flagged(short: str) -> str:
    outliers, non_positive = FLAGGED[short]
    cols = COLUMNS[short]
    parts, nulled = [], {}
    for c in outliers:
        parts.append(
            f"SELECT 'outlier' AS check, '{c}' AS column_name, {project(cols, nulled)} FROM fenced "
            f"WHERE {named_outlier(c)}"
        )
        if short == "encounters":
            nulled[c] = f"CASE WHEN {named_outlier(c)} THEN NULL ELSE {c} END"
    for c in non_positive:
        parts.append(f"SELECT 'non_positive', '{c}', {project(cols, {})} FROM rows WHERE {c} <= 0")
    if short == "facilities":
        parts.append(
            f"SELECT 'domain', 'teaching_hospital', {project(cols, {})} FROM rows "
            "WHERE teaching_hospital NOT IN (0, 1)"
        )
    return f"{cleaned(short)}, fenced AS ({with_quartiles(outliers)}) " + " UNION ALL ".join(parts)


def encounters_severity_listing() -> str:
    """Severity outliers as listed third, when the two earlier columns are already nulled."""
    earlier = ENCOUNTER_OUTLIERS[:2]
    nulled = {c: f"CASE WHEN {named_outlier(c)} THEN NULL ELSE {c} END" for c in earlier}
    return (
        f"{cleaned('encounters')} SELECT {project(COLUMNS['encounters'], nulled)} "
        f"FROM ({with_quartiles(ENCOUNTER_OUTLIERS)}) WHERE {named_outlier('encounter_severity')}"
    )


def all_oracles() -> dict[str, str]:
    out = dict(OPERATORS)
    for short in COLUMNS:
        out[f"job_{short}"] = job(short)
        out[f"profile_{short}"] = profile(short)
        out[f"values_{short}"] = values(short)
        out[f"run_{short}"] = job(short, through_csv(short))
    for short in FLAGGED:
        out[f"flagged_{short}"] = flagged(short)
    ranks = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {q}::DOUBLE AS quartile, count({c}) AS rows, true AS within FROM rows"
        for c in ENCOUNTER_OUTLIERS
        for q in (0.25, 0.75)
    )
    out["quartile_ranks_encounters"] = f"{cleaned('encounters')} {ranks}"
    untouched = f"* EXCLUDE ({', '.join(ENCOUNTER_OUTLIERS)})"
    out["run_encounters_default"] = (
        f"{cleaned('encounters', through_csv('encounters'))} SELECT {untouched} FROM rows"
    )
    for report, sql in (("profile", profile), ("values", values), ("flagged", flagged)):
        out[f"run_facilities_{report}"] = sql("facilities")
    out["run_facilities_raw_columns"] = """
        SELECT * FROM (VALUES
            (' Facility Id ', 'string'), (' Facility Name ', 'string'), (' Region ', 'string'),
            (' Bed Count ', 'int'), (' Teaching Hospital ', 'int'), (' Avg Patients Per Nurse ', 'double')
        ) AS t(column_name, data_type)"""
    out["listing_encounters_outliers"] = encounters_severity_listing()
    out["listing_facilities_outliers"] = (
        f"{cleaned('facilities')} SELECT {project(COLUMNS['facilities'], {})} "
        f"FROM ({with_quartiles(['bed_count'])}) WHERE {named_outlier('bed_count')}"
    )
    out["listing_facilities_domain"] = (
        f"{cleaned('facilities')} SELECT * FROM rows WHERE teaching_hospital NOT IN (0, 1)"
    )
    out["listing_labs_non_positive"] = (
        f"{cleaned('labs')} SELECT * FROM rows WHERE glucose_mg_dl <= 0"
    )
    out["listing_patients_distinct"] = f"{cleaned('patients')} SELECT DISTINCT ethnicity FROM rows"
    return out
