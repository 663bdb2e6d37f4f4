"""Explicit read schemas for the raw feeds (never inferred: zip codes keep leading zeros)."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

PATIENT_CSV_COLUMNS = [
    "Id", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST",
    "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
    "CITY", "STATE", "COUNTY", "FIPS", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES",
    "HEALTHCARE_COVERAGE", "INCOME", "BMI",
]
PATIENTS_SCHEMA = T.StructType([T.StructField(c, _S) for c in PATIENT_CSV_COLUMNS])

CONDITION_CSV_COLUMNS = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"]
CONDITIONS_SCHEMA = T.StructType([T.StructField(c, _S) for c in CONDITION_CSV_COLUMNS])

# `context` is a nested object in the files; reading it as STRING keeps its raw JSON text.
READINGS_SCHEMA = T.StructType([
    T.StructField("reading_id", _S),
    T.StructField("patient_id", _S),
    T.StructField("device_serial", _S),
    T.StructField("metric_code", _S),
    T.StructField("value", T.DecimalType(10, 4)),
    T.StructField("unit", _S),
    T.StructField("quality_flag", _S),
    T.StructField("measured_at", _S),
    T.StructField("context", _S),
])

ALERTS_SCHEMA = T.StructType([
    T.StructField("alert_id", _S),
    T.StructField("patient_id", _S),
    T.StructField("device_serial", _S),
    T.StructField("alert_type", _S),
    T.StructField("severity", _S),
    T.StructField("metric_code", _S),
    T.StructField("threshold_value", T.DoubleType()),
    T.StructField("actual_value", T.DoubleType()),
    T.StructField("triggered_at", _S),
    T.StructField("reading_id", _S),
])

CONTEXT_SCHEMA = T.StructType([
    T.StructField("activity", _S),
    T.StructField("location_type", _S),
])
