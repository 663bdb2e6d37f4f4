"""Threshold breach windows and alerts (AL1: WIN8 gaps-and-islands, JN11 threshold join).

Per (patient, metric, calendar day, severity, direction) the readings are ordered by
(measured_at, reading_id). A window of that key opens at the first breaching reading and closes
at the first reading that does not breach it (or at the end of the day). Every matching
threshold keeps its own window, so a critical run also yields a warning run.

Spark shape (exact, skew-tolerant — a distributed prefix sum):

1. readings ⋈ broadcast(8 thresholds); each row gets an hour-of-day bucket.
2. Window per (key, bucket) ordered by (measured_at, reading_id): the running count of
   non-breaching rows inside the bucket, and the bucket's total. A hot key's raw rows are
   therefore spread over up to 24 bucket tasks instead of one.
3. Aggregate per (key, bucket, running count) over breaching rows plus each bucket's last row:
   one compact row per run fragment (first reading, worst reading, size) and one marker per
   bucket carrying the bucket's non-breaching total. No shuffle (same partitioning).
4. Window per key over the compact rows only: carry = sum of earlier buckets' totals; the
   island id is carry + running count, so fragments of one run that crosses bucket borders
   get the same id, and a bucket of non-breaching rows separates runs.
5. Aggregate fragments per island (no shuffle). Two exchanges in total: raw rows by
   (key, bucket), compact fragments by key.

``breach_windows_single_pass`` is the direct one-window form, kept as a reference for tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsevault.fixed_values import THRESHOLDS
from pulsevault.functions import surrogate_key

ALERT_TYPE = "threshold_breach"
KEY = ["patient_id", "metric_code", "report_date", "severity", "direction"]


def thresholds_df(spark: SparkSession, thresholds=THRESHOLDS) -> DataFrame:
    """The threshold dimension (a fixed handful of rows: broadcast-safe)."""
    return spark.createDataFrame(
        [(m, s, d, float(v)) for m, s, d, v, _ in thresholds],
        "metric_code string, severity string, direction string, threshold_value double",
    )


def breach_match(readings: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """JN11: every (reading, threshold) pair of the reading's metric, with the strict breach test."""
    th = thresholds if thresholds is not None else thresholds_df(readings.sparkSession)
    r = readings.select("patient_id", "device_serial", "metric_code", "value", "measured_at", "reading_id")
    x = r.join(F.broadcast(th), "metric_code", "inner")
    t = F.col("threshold_value").cast("decimal(10,4)")
    breach = F.when(F.col("direction") == "above", F.col("value") > t).otherwise(F.col("value") < t)
    return x.withColumn("report_date", F.to_date("measured_at")).withColumn("is_breach", F.coalesce(breach, F.lit(False)))


def _window_row():
    return F.struct("measured_at", "reading_id", "device_serial")


def _signed():
    return F.when(F.col("direction") == "above", -F.col("value")).otherwise(F.col("value"))


def run_fragments(readings: DataFrame, thresholds: DataFrame | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Steps 1 to 3: what every (key, bucket) holds, one row per run fragment and a marker (see module doc). The
    readings of a bucket must be there together; buckets may come one after the other."""
    x = breach_match(readings, thresholds)
    ts = F.col("measured_at")
    tod = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    x = x.withColumn("__b", F.floor(tod / F.lit(bucket_seconds)))
    nb = F.when(F.col("is_breach"), 0).otherwise(1)
    wb = Window.partitionBy(*KEY, "__b").orderBy("measured_at", "reading_id")
    run = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.select("*", F.sum(nb).over(run).alias("__local"), F.sum(nb).over(full).alias("__btotal"),
                 (F.count(F.lit(1)).over(run) == F.count(F.lit(1)).over(full)).alias("__is_last"))
    brk = F.col("is_breach")
    return x.where(brk | F.col("__is_last")).groupBy(*KEY, "__b", "__local").agg(
        F.count_if(brk).alias("__n"),
        F.max(F.when(brk, F.col("threshold_value"))).alias("threshold_value"),
        F.min(F.when(brk, _window_row())).alias("__first"),
        F.min_by(F.when(brk, F.struct("reading_id", "value", "measured_at")),
                 F.when(brk, F.struct(_signed(), "measured_at", "reading_id"))).alias("__worst"),
        F.min(F.when(brk, F.struct(_signed().alias("s"), "measured_at", "reading_id"))).alias("__wkey"),
        F.max("__btotal").alias("__btotal"),
        F.max("__is_last").alias("__has_last"),
    )


def stitched(frag: DataFrame) -> DataFrame:
    """Steps 4 and 5: the breach windows of the fragments of whole days."""
    wk = Window.partitionBy(*KEY).orderBy("__b", "__local").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce(F.sum(F.when(F.col("__has_last"), F.col("__btotal")).otherwise(0)).over(wk), F.lit(0))
    frag = frag.select("*", (carry + F.col("__local")).alias("__island")).where(F.col("__n") > 0)
    return frag.groupBy(*KEY, "__island").agg(
        F.max("threshold_value").alias("threshold_value"),
        F.min("__first").alias("__first"),
        F.min_by("__worst", "__wkey").alias("__worst"),
        F.sum("__n").alias("n_readings"),
    ).select(*_out())


def breach_windows(readings: DataFrame, thresholds: DataFrame | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """WIN8/SRT4: one row per breach window with its first and worst reading (two-level, see module doc)."""
    return stitched(run_fragments(readings, thresholds, bucket_seconds))


def _out():
    return [*KEY, "threshold_value",
            F.col("__first.measured_at").alias("first_measured_at"),
            F.col("__first.reading_id").alias("first_reading_id"),
            F.col("__first.device_serial").alias("device_serial"),
            F.col("__worst.value").alias("worst_value"),
            F.col("__worst.reading_id").alias("worst_reading_id"),
            F.col("__worst.measured_at").alias("worst_measured_at"),
            "n_readings"]


def breach_windows_single_pass(readings: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Reference form: one running-sum window per key over all its rows (one task per key)."""
    x = breach_match(readings, thresholds)
    w = Window.partitionBy(*KEY).orderBy("measured_at", "reading_id") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = F.sum(F.when(F.col("is_breach"), 0).otherwise(1)).over(w)
    return x.withColumn("__island", island).where(F.col("is_breach")).groupBy(*KEY, "__island").agg(
        F.first("threshold_value").alias("threshold_value"),
        F.min(_window_row()).alias("__first"),
        F.min_by(F.struct("reading_id", "value", "measured_at"), F.struct(_signed(), "measured_at", "reading_id"))
        .alias("__worst"),
        F.count(F.lit(1)).alias("n_readings"),
    ).select(*_out())


def breach_alerts(readings: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """AL1: the alert feed (one alert per breach window); ids are deterministic hashes."""
    return alert_feed(breach_windows(readings, thresholds))


def alert_feed(windows: DataFrame) -> DataFrame:
    return windows.select(
        surrogate_key("patient_id", "metric_code", "severity", "direction", "first_measured_at").alias("alert_id"),
        "patient_id", "device_serial",
        F.lit(ALERT_TYPE).alias("alert_type"),
        "severity", "metric_code",
        F.col("threshold_value").cast("double").alias("threshold_value"),
        F.round(F.col("worst_value"), 2).cast("double").alias("actual_value"),
        F.col("first_measured_at").alias("triggered_at"),
        F.col("worst_reading_id").alias("reading_id"),
    )
