"""Staging projections (PRJ1-PRJ7, FLT1-FLT2): rename, cast, parse, stamp.

All are narrow (no shuffle) and keep filters on raw columns so they push into the scan.
``load_ts`` is an injected parameter, not the wall clock, so reruns are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsevault.fixed_values import SRC_SYNTHEA, SRC_WEARABLE
from pulsevault.functions import json_scalar, parse_iso_ts

DEFAULT_LOAD_TS = "2024-01-31 00:00:00"


def load_stamp(load_ts: str | Column = DEFAULT_LOAD_TS) -> Column:
    """PRJ6: the load timestamp as TIMESTAMP_NTZ (a literal, or a per-row column)."""
    if isinstance(load_ts, Column):
        return load_ts.cast("timestamp_ntz")
    return F.lit(load_ts).cast("timestamp_ntz")


def _ts(df: DataFrame, name: str) -> Column:
    """Timestamp column from either ISO text (files) or an already typed column (tables)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return parse_iso_ts(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def stg_patients(raw: DataFrame, load_ts=DEFAULT_LOAD_TS) -> DataFrame:
    """PRJ1: typed patients; bad BMI text becomes NULL (try_cast), NULL ids dropped."""
    return raw.where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("patient_id"),
        F.col("birthdate").cast("date").alias("birth_date"),
        F.col("gender").cast("string").alias("gender"),
        F.col("race").cast("string").alias("race"),
        F.col("ethnicity").cast("string").alias("ethnicity"),
        F.col("city").cast("string").alias("city"),
        F.col("state").cast("string").alias("state"),
        F.col("zip").cast("string").alias("zip"),
        F.col("bmi").try_cast("decimal(5,2)").alias("bmi"),
        F.col("first").cast("string").alias("first_name"),
        F.col("last").cast("string").alias("last_name"),
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_SYNTHEA).alias("record_source"),
    )


def stg_conditions(raw: DataFrame, load_ts=DEFAULT_LOAD_TS) -> DataFrame:
    """PRJ2: typed conditions; unparsable/empty STOP becomes NULL (active condition)."""
    return raw.where(F.col("patient").isNotNull() & F.col("code").isNotNull()).select(
        F.col("patient").cast("string").alias("patient_id"),
        F.col("code").cast("string").alias("condition_code"),
        F.col("description").cast("string").alias("condition_description"),
        F.col("start").cast("date").alias("onset_date"),
        F.col("stop").try_cast("date").alias("resolved_date"),
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_SYNTHEA).alias("record_source"),
    )


def quality_filter(raw: DataFrame) -> DataFrame:
    """FLT2: drop readings flagged 'missing' (three-valued: NULL flags are dropped too)."""
    return raw.where(F.col("quality_flag") != F.lit("missing"))


def stg_readings(raw: DataFrame, load_ts=DEFAULT_LOAD_TS) -> DataFrame:
    """PRJ3: typed readings with context fields pulled out of the raw JSON."""
    stamp = load_ts(raw) if callable(load_ts) else load_stamp(load_ts)
    return quality_filter(raw).where(F.col("reading_id").isNotNull() & F.col("patient_id").isNotNull()).select(
        F.col("reading_id").cast("string").alias("reading_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        F.col("device_serial").cast("string").alias("device_serial"),
        F.col("metric_code").cast("string").alias("metric_code"),
        F.col("value").cast("decimal(10,4)").alias("value"),
        F.col("unit").cast("string").alias("unit"),
        F.col("quality_flag").cast("string").alias("quality_flag"),
        _ts(raw, "measured_at").alias("measured_at"),
        json_scalar("context", "$.activity").alias("activity_type"),
        json_scalar("context", "$.location_type").alias("location_type"),
        stamp.alias("load_datetime"),
        F.lit(SRC_WEARABLE).alias("record_source"),
    )


def daily_load_stamp(raw: DataFrame) -> Column:
    """Per-row stamp of a daily batch: the day's file lands at 00:00 of the next day."""
    return F.to_timestamp_ntz(F.date_add(F.to_date(_ts(raw, "measured_at")), 1).cast("string"))


def stg_alerts(raw: DataFrame, load_ts=DEFAULT_LOAD_TS) -> DataFrame:
    """PRJ4: typed alerts."""
    return raw.where(F.col("alert_id").isNotNull() & F.col("patient_id").isNotNull()).select(
        F.col("alert_id").cast("string").alias("alert_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        F.col("device_serial").cast("string").alias("device_serial"),
        F.col("alert_type").cast("string").alias("alert_type"),
        F.col("severity").cast("string").alias("severity"),
        F.col("metric_code").cast("string").alias("metric_code"),
        F.col("threshold_value").cast("decimal(10,4)").alias("threshold_value"),
        F.col("actual_value").cast("decimal(10,4)").alias("actual_value"),
        _ts(raw, "triggered_at").alias("triggered_at"),
        F.col("reading_id").cast("string").alias("reading_id"),
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_WEARABLE).alias("record_source"),
    )
