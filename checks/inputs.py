"""Dirty inputs derived from whole supplied tables.

The supplied tables are clean, so these views add nulls, blanks, padding, mixed case, bad flags,
outliers and copies. Each text is valid in Spark SQL and in DuckDB, and feeds both sides.
"""

# Copies: plain rows, exact repeats, and repeats that are equal only after cleaning.

_CUSTOMER = """
SELECT c_custkey,
       CASE WHEN c_custkey % 11 = 0 THEN '   '
            WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN '  ' || c_mktsegment || ' '
            ELSE lower(c_mktsegment) END AS seg,
       CASE WHEN c_custkey % 13 = 0 THEN NULL
            WHEN c_custkey % 97 = 0 THEN c_acctbal * 50
            ELSE c_acctbal END AS bal,
       CASE WHEN c_custkey % 17 = 0 THEN 2
            ELSE CAST(c_custkey % 2 AS INT) END AS flag
FROM customer
"""

DIRTY = f"SELECT * FROM ({_CUSTOMER}) a UNION ALL SELECT * FROM ({_CUSTOMER}) b WHERE c_custkey % 10 = 0"

_NOTES = """
SELECT conv_id * 7 + turn AS k,
       'E' || CAST(conv_id AS STRING) AS encounter_id,
       CASE WHEN (conv_id * 7 + turn) % 5 = 0 THEN '   '
            WHEN (conv_id * 7 + turn) % 7 = 0 THEN NULL
            WHEN (conv_id * 7 + turn) % 2 = 0 THEN upper(role)
            ELSE role END AS note_type,
       CASE WHEN (conv_id * 7 + turn) % 11 = 0 THEN ''
            ELSE text END AS note_text
FROM conversations
"""

NOTES = f"""
SELECT encounter_id, note_type, note_text FROM ({_NOTES}) a
UNION ALL SELECT encounter_id, note_type, note_text FROM ({_NOTES}) b WHERE k % 6 = 0
UNION ALL SELECT encounter_id || ' ', ' ' || note_type, '  ' || note_text || ' ' FROM ({_NOTES}) c WHERE k % 4 = 0
UNION ALL SELECT encounter_id, upper(note_type), note_text FROM ({_NOTES}) d WHERE k % 9 = 0
"""

_ENCOUNTERS = """
SELECT o_orderkey AS k,
       'E' || CAST(o_orderkey AS STRING) AS encounter_id,
       ' P' || CAST(o_custkey AS STRING) || ' ' AS patient_id,
       'F' || CAST(o_orderkey % 50 AS STRING) AS facility_id,
       CASE WHEN o_orderkey % 11 = 0 THEN ''
            WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE ' ' || o_orderpriority END AS admission_type,
       o_orderstatus || '  ' AS department,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Cardiac ' ELSE 'RENAL' END AS primary_diagnosis_group,
       CASE WHEN o_orderkey % 19 = 0 THEN '  ' ELSE 'Home' END AS discharge_disposition,
       CAST(CASE WHEN o_orderkey % 101 = 0 THEN 100 ELSE o_orderkey % 10 END AS INT) AS encounter_severity,
       CAST(CASE WHEN o_orderkey % 211 = 0 THEN 90
                 WHEN o_orderkey % 23 = 0 THEN NULL
                 ELSE o_custkey % 14 END AS INT) AS length_of_stay_days,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderkey % 97 = 0 THEN o_totalprice * 50
            ELSE o_totalprice END AS total_cost_usd,
       CAST(o_orderkey % 2 AS INT) AS adverse_outcome_flag,
       CAST(o_custkey % 2 AS INT) AS readmitted_30_days_flag,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 1 END AS polypharmacy_flag,
       CAST(o_custkey % 3 AS INT) AS opioid_prescribed_flag
FROM orders
"""

_ENCOUNTER_REST = """
patient_id, facility_id, admission_type, department, primary_diagnosis_group, discharge_disposition,
encounter_severity, length_of_stay_days, total_cost_usd, adverse_outcome_flag,
readmitted_30_days_flag, polypharmacy_flag, opioid_prescribed_flag
"""

ENCOUNTERS = f"""
SELECT encounter_id, {_ENCOUNTER_REST} FROM ({_ENCOUNTERS}) a
UNION ALL SELECT encounter_id, {_ENCOUNTER_REST} FROM ({_ENCOUNTERS}) b WHERE k % 10 = 0
UNION ALL SELECT lower(encounter_id), {_ENCOUNTER_REST} FROM ({_ENCOUNTERS}) c WHERE k % 9 = 0
"""

_FACILITIES = """
SELECT s_suppkey AS k,
       'FAC' || CAST(s_suppkey AS STRING) AS facility_id,
       s_name || ' ' AS facility_name,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL
            WHEN s_suppkey % 5 = 0 THEN ' '
            WHEN s_nationkey % 2 = 0 THEN 'North'
            ELSE ' SOUTH' END AS region,
       CAST(CASE WHEN s_suppkey % 31 = 0 THEN 5000
                 WHEN s_suppkey % 29 = 0 THEN 0
                 WHEN s_suppkey % 37 = 0 THEN NULL
                 ELSE 100 + s_suppkey % 80 END AS INT) AS bed_count,
       CAST(CASE WHEN s_suppkey % 17 = 0 THEN 2
                 WHEN s_suppkey % 19 = 0 THEN NULL
                 ELSE s_suppkey % 2 END AS INT) AS teaching_hospital,
       CASE WHEN s_suppkey % 41 = 0 THEN s_acctbal * 50 ELSE s_acctbal / 1000 END AS avg_patients_per_nurse
FROM supplier
"""

_FACILITY_REST = "bed_count, teaching_hospital, avg_patients_per_nurse"

FACILITIES = f"""
SELECT facility_id, facility_name, region, {_FACILITY_REST} FROM ({_FACILITIES}) a
UNION ALL SELECT facility_id, facility_name, region, {_FACILITY_REST} FROM ({_FACILITIES}) b WHERE k % 4 = 0
UNION ALL SELECT ' ' || lower(facility_id), upper(facility_name), region, {_FACILITY_REST}
          FROM ({_FACILITIES}) c WHERE k % 3 = 0
"""

_MEDICATIONS = """
SELECT l_orderkey AS k,
       'E' || CAST(l_orderkey AS STRING) AS encounter_id,
       CASE WHEN l_partkey % 11 = 0 THEN '  '
            WHEN l_partkey % 7 = 0 THEN NULL
            WHEN l_partkey % 2 = 0 THEN 'Class ' || l_returnflag || ' '
            ELSE 'class ' || lower(l_returnflag) END AS medication_class,
       l_linenumber AS dose_no
FROM lineitem
"""

MEDICATIONS = f"""
SELECT encounter_id, medication_class, dose_no FROM ({_MEDICATIONS}) a
UNION ALL SELECT ' ' || lower(encounter_id), medication_class, dose_no FROM ({_MEDICATIONS}) b WHERE k % 5 = 0
"""

_PATIENTS = """
SELECT c_custkey AS k,
       'P' || CAST(c_custkey AS STRING) AS patient_id,
       CASE WHEN c_custkey % 3 = 0 THEN ' F' WHEN c_custkey % 3 = 1 THEN 'm ' ELSE NULL END AS gender,
       CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Group ' || CAST(c_nationkey AS STRING) END AS ethnicity,
       ' ' || c_mktsegment AS insurance_type,
       CASE WHEN c_custkey % 4 = 0 THEN 'HIGH' ELSE 'low ' END AS socioeconomic_risk_level,
       CASE WHEN c_custkey % 5 = 0 THEN '   ' ELSE 'Never' END AS smoker_status,
       CAST(CASE WHEN c_custkey % 83 = 0 THEN -1
                 WHEN c_custkey % 89 = 0 THEN 400
                 WHEN c_custkey % 13 = 0 THEN NULL
                 ELSE 18 + c_custkey % 70 END AS INT) AS age,
       CAST(CASE WHEN c_custkey % 61 = 0 THEN 40 ELSE c_custkey % 6 END AS INT) AS chronic_condition_count
FROM customer
"""

_PATIENT_REST = """
gender, ethnicity, insurance_type, socioeconomic_risk_level, smoker_status, age, chronic_condition_count
"""

PATIENTS = f"""
SELECT patient_id, {_PATIENT_REST} FROM ({_PATIENTS}) a
UNION ALL SELECT lower(patient_id) || ' ', {_PATIENT_REST} FROM ({_PATIENTS}) b WHERE k % 8 = 0
"""

_LABS = """
SELECT event_id AS k,
       'E' || CAST(event_id AS STRING) AS encounter_id,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS avg_heart_rate_bpm,
       value * 2 AS avg_systolic_bp,
       CASE WHEN event_id % 59 = 0 THEN -value ELSE value + 70 END AS glucose_mg_dl,
       CASE WHEN event_id % 71 = 0 THEN value * 100 ELSE 20 + value / 10 END AS bmi,
       CAST(CASE WHEN event_id % 43 = 0 THEN 60 ELSE user_id % 5 END AS INT) AS abnormal_lab_count
FROM events
"""

_LAB_REST = "avg_heart_rate_bpm, avg_systolic_bp, glucose_mg_dl, bmi, abnormal_lab_count"

VITAL_LABS = f"""
SELECT encounter_id, {_LAB_REST} FROM ({_LABS}) a
UNION ALL SELECT lower(encounter_id), {_LAB_REST} FROM ({_LABS}) b WHERE k % 12 = 0
UNION ALL SELECT encounter_id, {_LAB_REST} FROM ({_LABS}) c WHERE k % 15 = 0
"""

RAW = {
    "clinical_notes": NOTES,
    "encounters": ENCOUNTERS,
    "facilities": FACILITIES,
    "medications": MEDICATIONS,
    "patients": PATIENTS,
    "vital_labs": VITAL_LABS,
}

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_QUOTED = """
SELECT c_custkey,
       'he said "' || c_mktsegment || '", then left' AS note,
       {whole} AS severity,
       CASE WHEN c_custkey % 3 = 0 THEN '2.5' ELSE {dose} END AS dose
FROM customer
"""
# The same customers twice, numbers written in two ways
QUOTED = (
    _QUOTED.format(whole="'3.0'", dose="'1'") + "UNION ALL" + _QUOTED.format(whole="'3'", dose="'1.0'")
)

# Lines of a CSV file: good ones, short ones, surplus fields with and without values, odd numbers
RECORDS = """
SELECT CASE WHEN c_custkey % 31 = 0 THEN CAST(c_custkey AS STRING) || ',"a ""b"", c",3,,EXTRA'
            WHEN c_custkey % 29 = 0 THEN CAST(c_custkey AS STRING) || ',x,4,'
            WHEN c_custkey % 23 = 0 THEN CAST(c_custkey AS STRING) || ',"N/A, none",N/A'
            WHEN c_custkey % 19 = 0 THEN CAST(c_custkey AS STRING) || ',short'
            ELSE CAST(c_custkey AS STRING) || ',' || c_mktsegment || ',' || CAST(c_nationkey AS STRING)
       END AS value
FROM customer
"""

# Values of every kind in text columns
TYPED = """
SELECT CAST(o_orderkey AS STRING) AS a_key,
       CASE WHEN o_orderkey % 7 = 0 THEN '3000000000' ELSE CAST(o_custkey AS STRING) END AS b_long,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS STRING)
            ELSE CAST(o_custkey AS STRING) || '.25' END AS c_number,
       CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE CAST(o_custkey AS STRING) END AS d_mixed,
       CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'False' END AS e_flag,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '2024-02-2' || CAST(o_orderkey % 10 AS STRING) END AS f_day,
       o_orderstatus AS g_text
FROM orders
"""
