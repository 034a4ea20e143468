"""The six hospital tables."""

from __future__ import annotations

from .spec import TableSpec

# Column names, types and step order that results depend on.

NOTES = TableSpec(
    name="clinical_notes",
    infer_rest=False,  # its columns are known by position only, and are text
    multiline=True,
    positional_names=("encounter_id", "note_type", "note_text"),
    trim_cols=("note_type", "note_text", "encounter_id"),
    casts={"encounter_id": "string"},
    dedup_stage="trimmed",
    blank_to_null_cols=("note_type", "note_text", "encounter_id"),
    text_cols=("note_type",),
    missing_test="null",
    missing_stage="after_dedup",
    missing_ratio=False,
    distinct_cols=("note_type",),
    distinct_ratio=False,
    length_cols=("note_text",),
)

_ENCOUNTER_TEXT = (
    "encounter_id",
    "patient_id",
    "facility_id",
    "admission_type",
    "department",
    "primary_diagnosis_group",
    "discharge_disposition",
)
_ENCOUNTER_NUMBERS = (
    "encounter_severity",
    "length_of_stay_days",
    "total_cost_usd",
    "adverse_outcome_flag",
    "readmitted_30_days_flag",
    "polypharmacy_flag",
    "opioid_prescribed_flag",
)

ENCOUNTERS = TableSpec(
    name="encounters",
    dedup_stage="raw",
    types=dict.fromkeys(_ENCOUNTER_TEXT, "string")
    | dict.fromkeys(("total_cost_usd", "length_of_stay_days", "encounter_severity"), "numeric"),
    text_cols=_ENCOUNTER_TEXT,
    missing_stage="after_dedup",
    missing_ratio=False,
    distinct_cols=_ENCOUNTER_TEXT,
    sample_cols=_ENCOUNTER_NUMBERS,
    describe_cols=_ENCOUNTER_NUMBERS,
    outlier_cols=("total_cost_usd", "length_of_stay_days", "encounter_severity"),
    outlier_policy="null",
)

FACILITIES = TableSpec(
    name="facilities",
    types=dict.fromkeys(("facility_id", "facility_name", "region"), "string")
    | dict.fromkeys(("bed_count", "avg_patients_per_nurse"), "numeric"),
    text_cols=("facility_id", "facility_name", "region"),
    distinct_cols=("facility_id", "facility_name", "region"),
    sample_cols=("bed_count", "teaching_hospital", "avg_patients_per_nurse"),
    describe_cols=("bed_count", "teaching_hospital", "avg_patients_per_nurse"),
    frequency_cols=("teaching_hospital",),
    domains={"teaching_hospital": (0, 1)},
    outlier_cols=("bed_count", "avg_patients_per_nurse"),
    non_positive_cols=("bed_count", "avg_patients_per_nurse"),
)

MEDICATIONS = TableSpec(
    name="medications",
    types=dict.fromkeys(("encounter_id", "medication_class"), "string"),
    text_cols=("encounter_id", "medication_class"),
    distinct_cols=("encounter_id", "medication_class"),
)

_PATIENT_TEXT = (
    "patient_id",
    "gender",
    "ethnicity",
    "insurance_type",
    "socioeconomic_risk_level",
    "smoker_status",
)

PATIENTS = TableSpec(
    name="patients",
    types=dict.fromkeys(_PATIENT_TEXT, "string")
    | dict.fromkeys(("age", "chronic_condition_count"), "numeric"),
    text_cols=_PATIENT_TEXT,
    distinct_cols=_PATIENT_TEXT,
    sample_cols=("age", "chronic_condition_count"),
    describe_cols=("age", "chronic_condition_count"),
    outlier_cols=("age", "chronic_condition_count"),
    non_positive_cols=("age", "chronic_condition_count"),
)

_LAB_NUMBERS = (
    "avg_heart_rate_bpm",
    "avg_systolic_bp",
    "glucose_mg_dl",
    "bmi",
    "abnormal_lab_count",
)

VITAL_LABS = TableSpec(
    name="vital_labs",
    types={"encounter_id": "string"} | dict.fromkeys(_LAB_NUMBERS, "numeric"),
    text_cols=("encounter_id",),
    distinct_cols=("encounter_id",),
    sample_cols=_LAB_NUMBERS,
    outlier_cols=_LAB_NUMBERS,
    non_positive_cols=_LAB_NUMBERS,
)

TABLES = {
    spec.name: spec
    for spec in (NOTES, ENCOUNTERS, FACILITIES, MEDICATIONS, PATIENTS, VITAL_LABS)
}
