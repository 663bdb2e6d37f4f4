"""Marts (MT1 feature table, MT2 dashboard).

The feature table keeps every per-patient window on one partitioning (``patient_hk``); the
dashboard fuses the source's repeated scans (latest HR, latest SpO2, latest score, last
anomaly day, trend buckets) into single conditional aggregates per input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.functions import (
    age_years, days_between, dec_mean_from_parts, dec_sum_parts, dec_to_int, round_ratio,
)
from pulsevault.operators.business import latest_demographics

DEFAULT_AS_OF = "2024-01-31"
#: Days before the as-of day that the dashboard's trend compares.
TREND_DAYS = 6


def vitals_wide(daily: DataFrame) -> DataFrame:
    """AGG7/AGG13: one row per patient-day, 13 conditional measures + average completeness."""
    m = F.col("metric_code")

    def pick(code, col):
        return F.max(F.when(m == code, col))
    return daily.groupBy("patient_hk", "report_date").agg(
        pick("heart_rate", F.col("value_mean")).alias("hr_mean"),
        pick("heart_rate", F.col("value_std")).alias("hr_std"),
        pick("heart_rate", F.col("value_min")).alias("hr_min"),
        pick("heart_rate", F.col("value_max")).alias("hr_max"),
        pick("heart_rate", F.col("value_p05")).alias("hr_p05"),
        pick("heart_rate", F.col("value_p95")).alias("hr_p95"),
        pick("spo2", F.col("value_mean")).alias("spo2_mean"),
        pick("spo2", F.col("value_min")).alias("spo2_min"),
        pick("steps", F.col("reading_count") * F.col("value_mean")).alias("steps_total"),
        pick("skin_temperature", F.col("value_mean")).alias("skin_temp_mean"),
        pick("blood_glucose", F.col("value_mean")).alias("glucose_mean"),
        pick("blood_glucose", F.col("value_std")).alias("glucose_std"),
        pick("sleep_stage", round_ratio(F.col("reading_count"), F.lit(60), 1, 10)).alias("sleep_duration_hrs"),
        F.sum((F.col("completeness_pct") * 100).cast("long")).alias("__cs"),
        F.count("completeness_pct").alias("__cn"),
    ).withColumn("data_completeness", dec_mean_from_parts("__cs", "__cn", 2, 5)).drop("__cs", "__cn")


def rolling_vitals(wide: DataFrame) -> DataFrame:
    """WIN3/WIN5: 7-row averages (decimal, half-up at scale 4) and the previous-row HR delta."""
    w = Window.partitionBy("patient_hk").orderBy("report_date")
    w7 = w.rowsBetween(-6, 0)
    out = wide
    for src, dst in [("hr_mean", "hr_mean_7d_avg"), ("spo2_min", "spo2_min_7d_avg"),
                     ("steps_total", "steps_total_7d_avg")]:
        s, n = dec_sum_parts(src, 4)
        out = out.withColumn(dst, dec_mean_from_parts(s.over(w7), n.over(w7), 4, 20))
    return out.withColumn("hr_mean_delta_1d", F.col("hr_mean") - F.lag("hr_mean").over(w))


def label_next_day(scores: DataFrame) -> DataFrame:
    """JN7: tomorrow's flag keyed by today's date (calendar shift, not the next row)."""
    return scores.select("patient_hk", F.date_sub("report_date", 1).alias("report_date"),
                         F.col("anomaly_flag").alias("anomaly_next_24h"))


def daily_features(daily: DataFrame, sat_demo: DataFrame, risk: DataFrame, scores: DataFrame) -> DataFrame:
    """MT1: the ML feature table (31 columns). Inner joins drop each patient's unscored first day."""
    rv = rolling_vitals(vitals_wide(daily))
    demo = latest_demographics(sat_demo).select("patient_hk", "gender", "bmi")
    r = risk.select("patient_hk", "report_date", "age", "condition_count", "has_diabetes", "has_hypertension",
                    "has_cardiac_condition", "anomaly_events_30d", "risk_tier")
    a = scores.select("patient_hk", "report_date", "composite_anomaly_score")
    j = (rv.join(demo, "patient_hk", "inner")
         .join(r, ["patient_hk", "report_date"], "inner")
         .join(a, ["patient_hk", "report_date"], "inner")
         .join(label_next_day(scores), ["patient_hk", "report_date"], "left"))

    def d(c, p, s):
        return F.col(c).cast(f"decimal({p},{s})").alias(c)
    return j.select(
        "patient_hk", "report_date", "age", "gender", d("bmi", 5, 2),
        "has_diabetes", "has_hypertension", "has_cardiac_condition", "condition_count",
        d("hr_mean", 8, 4), d("hr_std", 8, 4), d("hr_min", 8, 4), d("hr_max", 8, 4), d("hr_p05", 8, 4),
        d("hr_p95", 8, 4), d("spo2_mean", 8, 4), d("spo2_min", 8, 4),
        dec_to_int("steps_total").alias("steps_total"),
        d("skin_temp_mean", 8, 4), d("glucose_mean", 8, 4), d("glucose_std", 8, 4),
        d("sleep_duration_hrs", 6, 2),
        d("hr_mean_7d_avg", 8, 4), d("hr_mean_delta_1d", 8, 4), d("spo2_min_7d_avg", 8, 4),
        d("steps_total_7d_avg", 10, 2),
        d("composite_anomaly_score", 8, 4),
        "anomaly_events_30d",
        d("data_completeness", 5, 2),
        "risk_tier",
        F.coalesce(F.col("anomaly_next_24h"), F.lit(False)).alias("anomaly_next_24h"),
    )


# ---------------------------------------------------------------------------
# MT2 dashboard
# ---------------------------------------------------------------------------


def latest_vitals(sat_reading_value: DataFrame) -> DataFrame:
    """WIN2: latest HR and SpO2 value per patient in one aggregate (max_by on (time, key))."""
    rv = sat_reading_value.where(F.col("metric_code").isin("heart_rate", "spo2"))
    m = F.col("metric_code")
    order = F.struct("measured_at", "reading_hk")
    return rv.groupBy("patient_hk").agg(
        F.max_by("value", F.when(m == "heart_rate", order)).alias("latest_hr"),
        F.max_by("value", F.when(m == "spo2", order)).alias("latest_spo2"),
    )


def score_summary(days: DataFrame, as_of) -> DataFrame:
    """WIN1/AGG8/AGG10/DT5 fused: per patient, the latest risk tier and score, days since the
    last anomaly day and the 3-day trend — one aggregate over the scored patient-days
    (``patient_hk, report_date, risk_tier, composite_anomaly_score, anomaly_flag``)."""
    d = F.col("report_date")
    recent = d >= F.date_sub(as_of, 3)
    prior = (d >= F.date_sub(as_of, 6)) & (d < F.date_sub(as_of, 3))
    sc = F.col("composite_anomaly_score")
    rs, rn = dec_sum_parts(F.when(recent, sc), 4)
    ps, pn = dec_sum_parts(F.when(prior, sc), 4)
    g = days.groupBy("patient_hk").agg(
        F.max_by("risk_tier", "report_date").alias("risk_tier"),
        F.max_by("composite_anomaly_score", "report_date").alias("anomaly_score_today"),
        F.max(F.when(F.col("anomaly_flag"), d)).alias("__last_anomaly"),
        rs.alias("__rs"), rn.alias("__rn"), ps.alias("__ps"), pn.alias("__pn"),
    )
    recent_avg = dec_mean_from_parts("__rs", "__rn", 4, 8)
    prior_avg = dec_mean_from_parts("__ps", "__pn", 4, 8)
    return g.select("patient_hk", "risk_tier", "anomaly_score_today",
                    trend_label(recent_avg, prior_avg).alias("anomaly_trend"),
                    days_between("__last_anomaly", as_of).alias("days_since_last_anomaly"))


def anomaly_trend(scores: DataFrame, as_of) -> DataFrame:
    """AGG8/CASE3: last-3-days vs previous-3-days average score for patients scored in the last 6 days."""
    d = F.col("report_date")
    sc = F.col("composite_anomaly_score")
    rs, rn = dec_sum_parts(F.when(d >= F.date_sub(as_of, 3), sc), 4)
    ps, pn = dec_sum_parts(F.when((d >= F.date_sub(as_of, 6)) & (d < F.date_sub(as_of, 3)), sc), 4)
    g = scores.where(d >= F.date_sub(as_of, 6)).groupBy("patient_hk").agg(
        rs.alias("__rs"), rn.alias("__rn"), ps.alias("__ps"), pn.alias("__pn"))
    recent_avg = dec_mean_from_parts("__rs", "__rn", 4, 8)
    prior_avg = dec_mean_from_parts("__ps", "__pn", 4, 8)
    return g.select("patient_hk", recent_avg.alias("recent_avg"), prior_avg.alias("prior_avg"),
                    trend_label(recent_avg, prior_avg).alias("anomaly_trend"))


def trend_label(recent_avg, prior_avg):
    return (F.when(recent_avg.isNull() | prior_avg.isNull(), "stable")
            .when(recent_avg < prior_avg * F.lit(0.9).cast("decimal(1,1)"), "improving")
            .when(recent_avg > prior_avg * F.lit(1.1).cast("decimal(2,1)"), "worsening")
            .otherwise("stable"))


def days_since_anomaly(scores: DataFrame, as_of) -> DataFrame:
    """AGG10/DT5: days from the last flagged day to ``as_of`` (flagged patients only)."""
    return scores.where(F.col("anomaly_flag")).groupBy("patient_hk").agg(
        days_between(F.max("report_date"), as_of).alias("days_since_last_anomaly"))


def active_alert_counts(sat_alert: DataFrame, hub_alert: DataFrame, lnk_reading_alert: DataFrame,
                        sat_reading_value: DataFrame) -> DataFrame:
    """JN4/AGG9: unacknowledged alerts per patient through alert -> hub -> link -> reading. An alert names a
    reading of its own metric, no earlier than the day it was triggered, so the readings are cut to the
    alerts' metrics (a broadcast of the metric dimension at most) and days before they are shuffled."""
    ad = sat_alert.where(~F.col("acknowledged")).select("alert_hk")
    ha = hub_alert.select("alert_hk")
    lra = lnk_reading_alert.select("alert_hk", "reading_hk")
    first_day = sat_alert.agg(F.min(F.to_date("triggered_at")).cast("timestamp_ntz")).scalar()
    metrics = F.broadcast(sat_alert.select("metric_code").distinct())
    rv = sat_reading_value.where(F.col("measured_at") >= first_day).join(metrics, "metric_code", "left_semi") \
        .select("reading_hk", "patient_hk")
    return (ad.join(ha, "alert_hk").join(lra, "alert_hk").join(rv, "reading_hk")
            .groupBy("patient_hk").agg(F.count(F.lit(1)).alias("active_alerts")))


def anomaly_dashboard(sat_demo: DataFrame, hub_patient: DataFrame, days: DataFrame,
                      sat_reading_value: DataFrame, sat_alert: DataFrame, hub_alert: DataFrame,
                      lnk_reading_alert: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """MT2: one row per scored patient with current status.

    ``days``: scored patient-days with ``risk_tier``, ``composite_anomaly_score`` and
    ``anomaly_flag`` (the fused timeline).
    """
    return dashboard_rows(sat_demo, hub_patient, score_summary(days, F.lit(as_of).cast("date")), latest_vitals(sat_reading_value),
                          active_alert_counts(sat_alert, hub_alert, lnk_reading_alert, sat_reading_value), as_of)


def summary_from_state(state: DataFrame, recent: DataFrame, as_of: str) -> DataFrame:
    """The rows of ``score_summary`` from the score state (``daystate.score_state``) and the scored days of the
    ``TREND_DAYS`` days before ``as_of`` and later ones."""
    as_of_c = F.lit(as_of).cast("date")
    trend = anomaly_trend(recent, as_of_c).select("patient_hk", "anomaly_trend")
    return state.join(trend, "patient_hk", "left").select(
        "patient_hk", F.col("last.risk_tier").alias("risk_tier"), F.col("last.composite_anomaly_score").alias("anomaly_score_today"),
        F.coalesce("anomaly_trend", F.lit("stable")).alias("anomaly_trend"),
        days_between("last_anomaly", as_of_c).alias("days_since_last_anomaly"))


def dashboard_rows(sat_demo: DataFrame, hub_patient: DataFrame, summary: DataFrame, vit: DataFrame, alerts: DataFrame,
                   as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """MT2 from the score summary, latest vitals and alert counts per patient, however they were found."""
    from pulsevault.operators.vault import latest_version
    as_of_c = F.lit(as_of).cast("date")
    demo = latest_version(sat_demo, "patient_hk", keep_ties=True).join(
        hub_patient.select("patient_hk", "patient_bk"), "patient_hk").select(
        "patient_hk", "patient_bk", age_years("birth_date", as_of_c).alias("age"))
    j = (demo.join(summary, "patient_hk")
         .join(vit, "patient_hk", "left").join(alerts, "patient_hk", "left"))
    return j.select(
        "patient_bk",
        F.col("patient_bk").cast("string").alias("patient_name"),
        "age", "risk_tier",
        F.col("latest_hr").cast("decimal(8,2)").alias("latest_hr"),
        F.col("latest_spo2").cast("decimal(8,2)").alias("latest_spo2"),
        F.col("anomaly_score_today").cast("decimal(8,4)").alias("anomaly_score_today"),
        "anomaly_trend",
        "days_since_last_anomaly",
        F.coalesce(F.col("active_alerts"), F.lit(0).cast("long")).alias("active_alerts"),
    )
