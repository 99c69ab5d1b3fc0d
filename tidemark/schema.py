"""Fixed values of the encounter domain and table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# Cleaning rules of the encounter table.
MISSING_MARKER = "?"
DROPPED_COLUMNS = ("encounter_id", "patient_nbr", "weight", "payer_code", "medical_specialty")
FILLED_COLUMNS = {c: "Unknown" for c in ("race", "diag_1", "diag_2", "diag_3")}
EXCLUDED_DISPOSITIONS = (11, 13, 14, 19, 20, 21)
TARGET_SOURCE = "readmitted"
TARGET = "readmitted_binary"
AGE_BRACKETS = {f"[{10 * i}-{10 * (i + 1)})": i for i in range(10)}
DRIFT_EXCLUDED = (
    "encounter_id", "patient_nbr", "readmitted", "readmitted_binary", "diag_1", "diag_2", "diag_3",
)
HYPHENATED = (
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
)

# The scoring contract, name -> (type, nullable).
INTEGER_FIELDS = (
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses",
)
DRUG_FIELDS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide_metformin", "glipizide_metformin", "glimepiride_pioglitazone",
    "metformin_rosiglitazone", "metformin_pioglitazone",
)

NULLABLE_TEXT_FIELDS = ("race", "diag_1", "diag_2", "diag_3", "max_glu_serum", "A1Cresult")
TEXT_FIELDS = ("gender", "age", *DRUG_FIELDS, "change", "diabetesMed")

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

