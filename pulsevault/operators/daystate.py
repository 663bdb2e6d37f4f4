"""Mergeable state of the daily batch: what a later load needs of earlier ones, without their readings.

* ``value_counts``: per (patient, metric, day) how often each value was read. Counts of two loads merge by
  adding up, and the daily statistics (BV1: counts, exact mean, deviation, extremes, percentiles) follow
  exactly from them, so a late reading costs its day's counts and not its day's readings. Values are rows,
  not lists: a flooding device makes a long group, never a large row.
* ``patient_state``: per patient the first and last day, the latest heart rate and SpO2 reading by (time,
  key) and the number of unacknowledged alerts; merged by min, max and sum (WIN2, AGG9 for the dashboard).
* ``score_state``: per patient the latest scored day with its tier and score, and the last day with an anomaly
  (WIN1, AGG10 for the dashboard). A load makes some days anew, so a stored day among them counts only if the
  load gives it again; where it does not (a late reading took an anomaly back) the patient is looked up in the
  history, see ``merged_scores``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.operators.business import daily_columns
from pulsevault.operators.staging import DEFAULT_LOAD_TS

GROUP = ["patient_hk", "metric_code", "report_date"]


def value_counts(sat_reading_value: DataFrame) -> DataFrame:
    return sat_reading_value.groupBy("patient_hk", "metric_code", F.to_date("measured_at").alias("report_date"), "value") \
        .agg(F.count(F.lit(1)).alias("n"))


def merged_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy(*GROUP, "value").agg(F.sum("n").alias("n"))


def _deviation(s: Column, n: Column, squares: Column) -> Column:
    """Sample standard deviation from integer sums: the difference of the squares is exact."""
    whole = n.cast("decimal(20,0)") * squares - s.cast("decimal(20,0)") * s.cast("decimal(20,0)")
    return F.when(n > 1, F.sqrt(whole.cast("double") / (n * (n - 1))) / 10000)


def daily_from_counts(counts: DataFrame, load_ts=DEFAULT_LOAD_TS) -> DataFrame:
    """BV1 from value counts: the rows of ``business.daily_stats``, in one shuffle by group."""
    unscaled, known = (F.col("value") * 10000).cast("long"), F.col("value").isNotNull()
    times = F.when(known, F.col("n"))
    w = Window.partitionBy(*GROUP)
    rows = counts.withColumn("__upto", F.sum(times).over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("__of", F.sum(times).over(w))

    def at(p: float) -> Column:
        return F.min(F.when(known & (F.col("__upto") >= F.ceil(F.lit(p) * F.col("__of"))), F.col("value")))
    g = rows.groupBy(*GROUP).agg(
        F.sum("n").alias("reading_count"), F.sum(unscaled * F.col("n")).alias("__s"),
        F.coalesce(F.sum(times), F.lit(0)).alias("__n"),
        F.sum(unscaled.cast("decimal(18,0)") * unscaled.cast("decimal(18,0)") * F.col("n")).cast("decimal(38,0)").alias("__q"),
        F.min("value").alias("value_min"), F.max("value").alias("value_max"), F.array(at(0.5), at(0.05), at(0.95)).alias("__pct"))
    g = g.withColumn("__std", _deviation(F.col("__s"), F.col("__n"), F.col("__q")))
    return daily_columns(g, load_ts, F.col("patient_hk"))


_LAST = "struct<measured_at:timestamp_ntz,reading_hk:string,value:decimal(10,4)>"


def reading_state(sat_reading_value: DataFrame) -> DataFrame:
    """The patient state that some readings make."""
    day, m = F.to_date("measured_at"), F.col("metric_code")
    last = F.struct("measured_at", "reading_hk", "value").cast(_LAST)
    return sat_reading_value.groupBy("patient_hk").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.max(F.when(m == "heart_rate", last)).alias("hr"), F.max(F.when(m == "spo2", last)).alias("spo2"),
        F.lit(0).cast("long").alias("active_alerts"))


def alert_state(active_alerts: DataFrame) -> DataFrame:
    """The patient state that some alerts (patient_hk, active_alerts) make."""
    none = F.lit(None)
    return active_alerts.select("patient_hk", none.cast("date").alias("first_day"), none.cast("date").alias("last_day"),
                                none.cast(_LAST).alias("hr"), none.cast(_LAST).alias("spo2"), "active_alerts")


def merged_state(*states: DataFrame) -> DataFrame:
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy("patient_hk").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.max("hr").alias("hr"),
        F.max("spo2").alias("spo2"), F.sum("active_alerts").alias("active_alerts"))


def latest_from_state(state: DataFrame) -> DataFrame:
    """WIN2: the rows of ``marts.latest_vitals``."""
    return state.where(F.col("hr").isNotNull() | F.col("spo2").isNotNull()).select(
        "patient_hk", F.col("hr.value").alias("latest_hr"), F.col("spo2.value").alias("latest_spo2"))


def alerts_from_state(state: DataFrame) -> DataFrame:
    """AGG9: the rows of ``marts.active_alert_counts``."""
    return state.where(F.col("active_alerts") > 0).select("patient_hk", "active_alerts")


def score_state(days: DataFrame) -> DataFrame:
    """The score state of some scored days (patient_hk, report_date, risk_tier, composite_anomaly_score, anomaly_flag)."""
    return days.groupBy("patient_hk").agg(
        F.max(F.struct("report_date", "risk_tier", "composite_anomaly_score")).alias("last"),
        F.max(F.when(F.col("anomaly_flag"), F.col("report_date"))).alias("last_anomaly"))


def merged_scores(old: DataFrame, fresh: DataFrame, spans: DataFrame) -> DataFrame:
    """``old`` score state with the days of ``spans`` (``affected.touched_spans``) made anew by the scored days
    ``fresh``; ``doubtful``: an earlier day than those made anew may be the right one, so the history must tell."""
    # names of their own: inside a lambda a name would mean the column that is made, not the one read
    state = old.select("patient_hk", F.col("last").alias("__last"), F.col("last_anomaly").alias("__anomaly")).join(spans, "patient_hk", "left")

    def anew(day: Column) -> Column:
        return F.coalesce(F.col("whole") | F.exists("spans", lambda s: day.between(s["a"], s["z"])), F.lit(False))
    day, anomaly, partly = F.col("__last.report_date"), F.col("__anomaly"), ~F.coalesce("whole", F.lit(False))
    kept = state.select(
        "patient_hk", F.when(~anew(day), F.col("__last")).alias("last"), F.when(~anew(anomaly), anomaly).alias("last_anomaly"),
        F.when(anew(day) & partly, day).alias("lost"), F.when(anew(anomaly) & partly, anomaly).alias("lost_anomaly"))
    none = F.lit(None).cast("date")
    rows = kept.unionByName(score_state(fresh).select("*", none.alias("lost"), none.alias("lost_anomaly")))
    g = rows.groupBy("patient_hk").agg(*[F.max(c).alias(c) for c in ("last", "last_anomaly", "lost", "lost_anomaly")])
    later = lambda lost, now: lost.isNotNull() & F.coalesce(now < lost, F.lit(True))
    return g.select("patient_hk", "last", "last_anomaly",
                    (later(F.col("lost"), F.col("last.report_date")) | later(F.col("lost_anomaly"), F.col("last_anomaly"))).alias("doubtful")).where("doubtful or last is not null")
