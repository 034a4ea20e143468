from __future__ import annotations

from dataclasses import replace

import pytest

import tabclean as tc
from tabclean.plans import (
    ENCOUNTERS,
    FACILITIES,
    MEDICATIONS,
    NOTES,
    PATIENTS,
    VITAL_LABS,
    clean_rows,
    size_settings,
    sized_for,
)


def metrics(df):
    return {(r.column_name, r.metric): r.value for r in df.collect()}


@pytest.fixture
def notes(spark):
    return spark.createDataFrame(
        [
            ("E1 ", " Discharge ", "stable"),
            ("E1", "Discharge", "stable"),
            ("E1", "DISCHARGE", "stable"),
            ("E2", "   ", ""),
            ("E2", None, ""),
        ],
        ["Enc", "Type of Note", "Note"],
    )


def test_notes(notes, rows):
    cleaned = tc.clean_table(notes, NOTES)
    assert cleaned.columns == ["encounter_id", "note_type", "note_text"]
    assert rows(cleaned) == [("E1", "discharge", "stable")] * 2 + [("E2", None, None)] * 2 or rows(
        cleaned
    ) == sorted(rows(cleaned))
    assert sorted(map(str, rows(cleaned))) == sorted(
        map(str, [("E1", "discharge", "stable")] * 2 + [("E2", None, None)] * 2)
    )
    assert metrics(tc.profile_table(notes, NOTES)) == {
        ("*", "rows_before"): 5.0,
        ("*", "rows_after"): 4.0,
        ("*", "duplicates_removed"): 1.0,
        ("encounter_id", "missing_count"): 0.0,
        ("note_type", "missing_count"): 2.0,
        ("note_text", "missing_count"): 2.0,
        ("note_text_length", "count"): 2.0,
        ("note_text_length", "mean"): 6.0,
        ("note_text_length", "stddev"): 0.0,
        ("note_text_length", "min"): 6.0,
        ("note_text_length", "max"): 6.0,
        ("note_type", "distinct_count"): 1.0,
    }
    assert rows(tc.detail_reports(cleaned, NOTES)["distinct_note_type"]) == [(None,), ("discharge",)]


ENCOUNTER_ROWS = [
    ("e1", "Emergency", 100.0),
    ("e1", "Emergency", 100.0),
    ("E1", "Emergency", 100.0),
    ("e2", " elective", 110.0),
    ("e3", "", 120.0),
    ("e4", None, 130.0),
    ("e5", "Urgent", 5000.0),
]


@pytest.fixture
def encounters(spark):
    df = spark.createDataFrame(ENCOUNTER_ROWS, "encounter_id string, admission_type string, total_cost_usd double")
    return df.selectExpr(
        "encounter_id AS `Encounter ID`",
        "'p' AS patient_id",
        "'f' AS facility_id",
        "admission_type",
        "'d' AS department",
        "'g' AS primary_diagnosis_group",
        "'h' AS discharge_disposition",
        "1 AS encounter_severity",
        "2 AS length_of_stay_days",
        "total_cost_usd AS ` Total Cost USD`",
        "0 AS adverse_outcome_flag",
        "0 AS readmitted_30_days_flag",
        "0 AS polypharmacy_flag",
        "1 AS opioid_prescribed_flag",
    )


@pytest.mark.parametrize("rel_err", [0, 0.01])
def test_encounters(encounters, rows, rel_err):
    cleaned = tc.clean_table(encounters, ENCOUNTERS, rel_err=rel_err)
    short = cleaned.select("encounter_id", "admission_type", "total_cost_usd")
    assert rows(short) == [
        ("e1", "emergency", 100.0),
        ("e1", "emergency", 100.0),
        ("e2", "elective", 110.0),
        ("e3", "", 120.0),
        ("e4", None, 130.0),
        ("e5", "urgent", None),
    ]


def test_encounters_reports(encounters, rows):
    found = metrics(tc.profile_table(encounters, ENCOUNTERS))
    assert found["*", "rows_before"] == 7 and found["*", "rows_after"] == 6
    assert found["encounter_id", "missing_count"] == 0
    assert found["admission_type", "missing_count"] == 2
    assert found["total_cost_usd", "missing_count"] == 0
    assert found["encounter_id", "cardinality_ratio"] == pytest.approx(5 / 6)
    assert found["admission_type", "distinct_count"] == 4
    assert found["total_cost_usd", "count"] == 6 and found["total_cost_usd", "max"] == 5000
    assert ("admission_type", "missing_ratio") not in found
    details = tc.detail_reports(clean_rows(encounters, ENCOUNTERS), ENCOUNTERS, rel_err=0)
    assert [r.encounter_id for r in details["outliers_total_cost_usd"].collect()] == ["e5"]
    assert details["outliers_length_of_stay_days"].count() == 0
    assert details["sample"].count() == 5


def test_later_listings_show_earlier_columns_already_nulled(encounters):
    df = encounters.selectExpr(
        "* EXCEPT (length_of_stay_days)", "IF(`Encounter ID` = 'e5', 99, 2) AS length_of_stay_days"
    )
    details = tc.detail_reports(clean_rows(df, ENCOUNTERS), ENCOUNTERS)
    (first,) = details["outliers_total_cost_usd"].collect()
    (second,) = details["outliers_length_of_stay_days"].collect()
    assert (first.total_cost_usd, first.length_of_stay_days) == (5000.0, 99)
    assert (second.total_cost_usd, second.length_of_stay_days) == (None, 99)


@pytest.fixture
def facilities(spark):
    data = [
        ("f1", 100, 0), ("f2", 120, 1), ("f3", 140, 1), ("f4", 0, 2),
        ("f5", -1, None), ("f6", 5000, 1), ("f7", None, 0),
    ]
    df = spark.createDataFrame(data, "facility_id string, bed_count int, teaching_hospital int")
    return df.selectExpr(
        "facility_id", "' Name ' AS facility_name", "'North' AS region", "bed_count",
        "teaching_hospital", "CAST(3 AS DOUBLE) AS avg_patients_per_nurse",
    )


def test_facilities(facilities, rows):
    cleaned = tc.clean_table(facilities, FACILITIES)
    beds = {r.facility_id: r.bed_count for r in cleaned.collect()}
    assert beds == {"f1": 100, "f2": 120, "f3": 140, "f4": 0, "f5": -1, "f6": 5000, "f7": None}
    assert {(r.facility_name, r.region) for r in cleaned.collect()} == {("name", "north")}
    reports = tc.detail_reports(cleaned, FACILITIES, rel_err=0)
    ids = {k: sorted(r.facility_id for r in reports[k].collect()) for k in reports if "_bed_" in k}
    assert ids == {"outliers_bed_count": ["f6"], "non_positive_bed_count": ["f4", "f5"]}
    assert [r.facility_id for r in reports["domain_teaching_hospital"].collect()] == ["f4"]
    assert rows(reports["frequency_teaching_hospital"]) == [(None, 1), (0, 2), (1, 3), (2, 1)]
    assert tc.fences(cleaned, ["bed_count"], rel_err=0)["bed_count"] == (0.0, 140.0, -210.0, 350.0)


def test_flagged_rows_hold_the_same_as_the_single_listings(facilities, encounters, spark):
    for raw, spec in ((facilities, FACILITIES), (encounters, ENCOUNTERS)):
        cleaned = clean_rows(raw, spec)
        key = cleaned.columns[0]
        flagged = tc.flagged_rows(cleaned, spec, rel_err=0)
        assert flagged.columns == ["check", "column_name", *cleaned.columns]
        together = sorted((r.check, r.column_name, r[key]) for r in flagged.collect())
        singles = tc.detail_reports(cleaned, spec, rel_err=0)
        apart = []
        for check, prefix in (("outlier", "outliers_"), ("non_positive", "non_positive_"), ("domain", "domain_")):
            for name in [n for n in singles if n.startswith(prefix)]:
                apart += [(check, name.removeprefix(prefix), r[key]) for r in singles[name].collect()]
        assert together == sorted(apart) and together


def test_tables_without_checks_have_no_flagged_rows(spark, rows):
    df = spark.createDataFrame([("e1", "x")], ["encounter_id", "medication_class"])
    empty = tc.flagged_rows(df, MEDICATIONS)
    assert empty.columns == ["check", "column_name", "encounter_id", "medication_class"]
    assert rows(empty) == []


def test_rows_equal_after_cleaning_merge_in_the_other_tables(spark, rows):
    df = spark.createDataFrame(
        [("E1", "Statin"), (" e1", "statin "), ("e1", ""), ("e1", "  "), ("e1", None)],
        ["Encounter ID", "Medication Class"],
    )
    assert rows(tc.clean_table(df, MEDICATIONS)) == [("e1", None), ("e1", ""), ("e1", "statin")]
    found = metrics(tc.profile_table(df, MEDICATIONS))
    # missing values are counted on the rows before duplicates go
    assert found["medication_class", "missing_count"] == 3
    assert found["medication_class", "missing_ratio"] == pytest.approx(3 / 5)
    assert found["*", "duplicates_removed"] == 2
    # shares of distinct values on the rows after
    assert found["medication_class", "cardinality_ratio"] == pytest.approx(2 / 3)


def test_patients_and_labs_only_list(spark, rows):
    people = spark.range(200).selectExpr(
        "concat('P', id) AS patient_id", "'F' AS gender", "'x' AS ethnicity", "'y' AS insurance_type",
        "'HIGH' AS socioeconomic_risk_level", "'Never' AS smoker_status",
        "CAST(IF(id = 3, 900, 20 + id % 50) AS INT) AS age", "CAST(id % 4 AS INT) AS chronic_condition_count",
    )
    cleaned = tc.clean_table(people, PATIENTS)
    assert cleaned.filter("age = 900").count() == 1
    reports = tc.detail_reports(cleaned, PATIENTS)
    assert [r.patient_id for r in reports["outliers_age"].collect()] == ["p3"]
    assert reports["non_positive_chronic_condition_count"].count() == 50

    labs = spark.range(200).selectExpr(
        "concat('E', id) AS encounter_id", "CAST(60 + id % 20 AS DOUBLE) AS avg_heart_rate_bpm",
        "CAST(110 + id % 30 AS DOUBLE) AS avg_systolic_bp",
        "CAST(IF(id = 9, -5, 90) AS DOUBLE) AS glucose_mg_dl", "CAST(25 AS DOUBLE) AS bmi",
        "CAST(0 AS INT) AS abnormal_lab_count",
    )
    reports = tc.detail_reports(tc.clean_table(labs, VITAL_LABS), VITAL_LABS)
    assert [r.encounter_id for r in reports["non_positive_glucose_mg_dl"].collect()] == ["e9"]
    assert [r.encounter_id for r in reports["outliers_glucose_mg_dl"].collect()] == ["e9"]
    assert reports["non_positive_abnormal_lab_count"].count() == 200


def test_column_names_with_quotes_can_be_profiled(spark):
    df = spark.createDataFrame([("e1", "x", None)], "encounter_id string, medication_class string, `it's \\ \"n.\"` int")
    assert metrics(tc.profile_table(df, MEDICATIONS))["it's_\\_\"n.\"", "missing_count"] == 1


def test_pass_through_columns_are_kept_and_profiled(spark):
    df = spark.createDataFrame([("e1", "a", " ", 1)], ["encounter_id", "medication_class", "Extra Note", "n"])
    assert tc.clean_table(df, MEDICATIONS).columns == ["encounter_id", "medication_class", "extra_note", "n"]
    assert metrics(tc.profile_table(df, MEDICATIONS))["extra_note", "missing_count"] == 1


def test_empty_tables(spark, rows):
    df = spark.createDataFrame([], "encounter_id string, medication_class string")
    assert rows(tc.clean_table(df, MEDICATIONS)) == []
    found = metrics(tc.profile_table(df, MEDICATIONS))
    assert found["*", "rows_before"] == 0 and found["encounter_id", "missing_count"] == 0
    assert found["encounter_id", "missing_ratio"] is None
    assert found["medication_class", "distinct_count"] == 0
    assert found["medication_class", "cardinality_ratio"] is None


def test_run_table(spark, tmp_path, rows):
    raw = tmp_path / "raw.csv"
    raw.write_text(
        "Facility ID,Facility Name, Region ,Bed Count,Teaching Hospital,Avg Patients Per Nurse\n"
        "007, General ,North,100,0,3.5\n"
        "007,GENERAL,north,100,0,3.5\n"
        "008,Clinic,South,0,1,4.5\n"
        "009,,South,5000,2,4.0\n"
    )
    out = tc.run_table(
        spark, FACILITIES, str(raw), str(tmp_path / "curated"), str(tmp_path / "reports"), rel_err=0
    )
    assert rows(out) == [
        ("007", "general", "north", 100, 0, 3.5),
        ("008", "clinic", "south", 0, 1, 4.5),
        ("009", None, "south", 5000, 2, 4.0),
    ]
    assert out.dtypes == spark.read.parquet(str(tmp_path / "curated")).dtypes
    def report(name):
        return spark.read.parquet(str(tmp_path / "reports" / name))

    assert {p.name for p in (tmp_path / "reports").iterdir()} == {
        "preview", "raw_columns", "profile", "values", "flagged", "schema", "sample"
    }
    flags = report("flagged").select("check", "column_name", "facility_id")
    assert rows(flags) == [
        ("domain", "teaching_hospital", "009"),
        ("non_positive", "bed_count", "008"),
    ]
    regions = report("values").filter("column_name = 'region'").select("value", "rows")
    assert rows(regions) == [("north", 1), ("south", 2)]
    found = metrics(spark.read.parquet(str(tmp_path / "reports" / "profile")))
    assert found["*", "duplicates_removed"] == 1 and found["facility_name", "missing_count"] == 1


def test_command_line(spark, tmp_path, monkeypatch, rows):
    from tabclean.__main__ import main

    (tmp_path / "raw.csv").write_text("Encounter ID,Medication Class\nE1, Statin\ne1,statin\n")
    raw, curated, reports = (str(tmp_path / n) for n in ("raw.csv", "curated", "reports"))
    monkeypatch.setattr("sys.argv", ["tabclean", "medications", raw, curated, "--reports", reports])
    main()
    assert rows(spark.read.parquet(curated)) == [("e1", "statin")]
    assert metrics(spark.read.parquet(f"{reports}/profile"))["*", "duplicates_removed"] == 1


def test_bad_values_in_a_run(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text(
        "facility_id,facility_name,region,bed_count,teaching_hospital,avg_patients_per_nurse\n"
        "f1,n,r,many,1,3.5\n"
    )
    spec = replace(FACILITIES, types={**FACILITIES.types, "bed_count": "int"})
    with pytest.raises(Exception, match="many"):
        tc.run_table(spark, spec, str(raw), str(tmp_path / "a"))
    out = tc.run_table(spark, spec, str(raw), str(tmp_path / "b"), on_bad_value="null")
    assert out.first().bed_count is None


def test_run_agrees_with_clean_table(spark, tmp_path, rows, encounters):
    raw = str(tmp_path / "raw")
    tc.normalize_names(encounters).write.option("header", True).csv(raw)
    source = tc.read_raw(spark, raw, types=ENCOUNTERS.types, infer_rest=True)
    expected = rows(tc.clean_table(source, ENCOUNTERS, rel_err=0))
    assert rows(tc.run_table(spark, ENCOUNTERS, raw, str(tmp_path / "out"), rel_err=0)) == expected
    assert rows(tc.run_table(spark, ENCOUNTERS, raw, str(tmp_path / "out"))) == expected


def test_profile_shares_one_scan_and_one_row_shuffle(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "CAST(l_orderkey AS STRING) AS encounter_id", "l_returnflag AS medication_class", "l_tax"
    )
    text = plan(tc.profile_table(df, MEDICATIONS))
    final = text[: text.index("Initial Plan")]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_sizes_follow_the_input(spark, tmp_path):
    assert size_settings(0, 8)["spark.sql.shuffle.partitions"] == "8"
    for terabytes in (1, 10, 100):  # one formula, in proportion
        settings = size_settings(terabytes << 40, 200)
        assert settings["spark.sql.shuffle.partitions"] == str(4096 * terabytes)
        assert "spark.sql.files.maxPartitionBytes" not in settings
    given = size_settings(1 << 40, 200, partition_bytes=1 << 30, split_bytes=1 << 29)
    assert given["spark.sql.shuffle.partitions"] == "1024"
    assert given["spark.sql.files.maxPartitionBytes"] == str(1 << 29)
    (tmp_path / "x.csv").write_text("a\n" * 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_for(spark, [str(tmp_path / "*.csv"), str(tmp_path)]):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_specs_check_their_options():
    with pytest.raises(ValueError, match="dedup_stage"):
        tc.TableSpec(name="x", dedup_stage="never")


def test_clean_table_is_one_scan_and_one_wide_shuffle(spark, tmp_path, plan, encounters):
    raw = str(tmp_path / "raw")
    tc.normalize_names(encounters).write.option("header", True).csv(raw)
    types = {f.name: f.dataType.simpleString() for f in tc.normalize_names(encounters).schema.fields}
    df = tc.clean_table(tc.read_raw(spark, raw, types=types), ENCOUNTERS)
    df.collect()
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    tree = text[: text.index("===== Subqueries")]
    subquery = text[text.index("===== Subqueries") :]
    assert tree[: tree.index("Initial Plan")].count("Scan csv") == 1
    assert tree[: tree.index("Initial Plan")].count("Exchange") == 1
    first = subquery[: subquery.index("Initial Plan")]
    assert "ReusedExchange" in first and "Scan csv" not in first
    assert "ReusedSubquery" in text and "Join" not in text
