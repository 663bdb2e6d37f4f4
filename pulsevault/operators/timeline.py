"""Fused patient-day timeline: anomaly scores, risk profiles and the feature mart in one pass.

The source builds these as separate tables joined on (patient, day). At day grain every one
of them is a window over a patient's history, so here they share a single physical shape:

1. ``patient_days``: the daily statistics are hash-partitioned by ``patient_hk`` once and
   pivoted to one row per patient-day (the partitioning satisfies the group-by, no second
   shuffle). The pivot carries the 13 mart measures, the three scored means, the day's
   average completeness and whether any scored metric was present.
2. Pass 1 (all patient-days, one sort by day number): 7-row rolling vitals, previous-row HR
   delta and the 30-day prior baseline (calendar range frame) — the source's 30x range
   self-join becomes a frame.
3. Scored days = days with a scored metric and at least one prior day; z-scores, composite,
   flag, contributors.
4. Pass 2 (scored days, same partitioning and order, no new sort): 7-row average score,
   30-row anomaly-day count and tomorrow's flag (a [1, 1] calendar range frame instead of the
   shifted self-join).
5. Latest demographics join on ``patient_hk``, which reuses the partitioning of the big side.

Each public function returns exactly the columns (and rows) of the corresponding source
model; ``tests/test_timeline.py`` checks them against the table-by-table operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.fixed_values import (
    ANOMALY_BASELINE_DAYS, ANOMALY_CONTRIB_ABOVE, ANOMALY_FLAG_ABOVE, ANOMALY_METRICS, ANOMALY_WEIGHTS,
    SRC_BUSINESS,
)
from pulsevault.functions import (
    age_years, contributing_list, day_number, dec_mean_from_parts, dec_sum_parts, dec_to_int, round_ratio,
)
from pulsevault.operators.business import condition_flags, latest_demographics, risk_tier
from pulsevault.operators.staging import DEFAULT_LOAD_TS, load_stamp

_P = [("heart_rate", "hr"), ("spo2", "spo2"), ("steps", "steps")]


def patient_days(daily: DataFrame) -> DataFrame:
    """AGG6 + AGG7 in one aggregate per patient-day, partitioned by patient."""
    m = F.col("metric_code")

    def pick(code, col):
        return F.max(F.when(m == code, col))
    d = daily.repartition("patient_hk")
    return d.groupBy("patient_hk", "report_date").agg(
        pick("heart_rate", F.col("value_mean")).alias("hr_mean"),
        pick("heart_rate", F.col("value_std")).alias("hr_std"),
        pick("heart_rate", F.col("value_min")).alias("hr_min"),
        pick("heart_rate", F.col("value_max")).alias("hr_max"),
        pick("heart_rate", F.col("value_p05")).alias("hr_p05"),
        pick("heart_rate", F.col("value_p95")).alias("hr_p95"),
        pick("spo2", F.col("value_mean")).alias("spo2_mean"),
        pick("spo2", F.col("value_min")).alias("spo2_min"),
        pick("steps", F.col("value_mean")).alias("steps_mean"),
        pick("steps", F.col("reading_count") * F.col("value_mean")).alias("steps_total"),
        pick("skin_temperature", F.col("value_mean")).alias("skin_temp_mean"),
        pick("blood_glucose", F.col("value_mean")).alias("glucose_mean"),
        pick("blood_glucose", F.col("value_std")).alias("glucose_std"),
        pick("sleep_stage", round_ratio(F.col("reading_count"), F.lit(60), 1, 10)).alias("sleep_duration_hrs"),
        F.sum((F.col("completeness_pct") * 100).cast("long")).alias("__cs"),
        F.count("completeness_pct").alias("__cn"),
        F.max(m.isin(ANOMALY_METRICS)).alias("__scored"),
    )


def _guarded(std: Column, num: Column) -> Column:
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise(num.cast("double") / std)


def scored_days(daily: DataFrame, days: int = ANOMALY_BASELINE_DAYS, flag_above: float = ANOMALY_FLAG_ABOVE,
                contrib_above: float = ANOMALY_CONTRIB_ABOVE) -> DataFrame:
    """Passes 1-4: every scored patient-day with vitals, rolling features, scores and label."""
    pdays = patient_days(daily)
    order = day_number("report_date")
    w = Window.partitionBy("patient_hk").orderBy(order)
    w7 = w.rowsBetween(-6, 0)
    wb = w.rangeBetween(-days, -1)
    roll = []
    for src, dst in [("hr_mean", "hr_mean_7d_avg"), ("spo2_min", "spo2_min_7d_avg"),
                     ("steps_total", "steps_total_7d_avg")]:
        s, n = dec_sum_parts(src, 4)
        roll.append(dec_mean_from_parts(s.over(w7), n.over(w7), 4, 20).alias(dst))
    base = []
    for _, p in _P:
        s, n = dec_sum_parts(f"{p}_mean", 4)
        base += [s.over(wb).alias(f"__{p}_s"), n.over(wb).alias(f"__{p}_n"),
                 F.stddev_samp(F.col(f"{p}_mean").cast("double")).over(wb).alias(f"__{p}_std")]
    pass1 = pdays.select(
        "*",
        dec_mean_from_parts("__cs", "__cn", 2, 5).alias("data_completeness"),
        *roll,
        (F.col("hr_mean") - F.lag("hr_mean").over(w)).alias("hr_mean_delta_1d"),
        F.count(F.when(F.col("__scored"), 1)).over(wb).alias("__prior"),
        *base,
    )
    scored = pass1.where(F.col("__scored") & (F.col("__prior") > 0))
    bm = {p: dec_mean_from_parts(f"__{p}_s", f"__{p}_n", 4, 10) for _, p in _P}
    hr_z = _guarded(F.col("__hr_std"), F.abs(F.col("hr_mean") - bm["hr"]))
    spo2_z = _guarded(F.col("__spo2_std"), bm["spo2"] - F.col("spo2_mean"))
    steps_z = _guarded(F.col("__steps_std"), F.abs(F.col("steps_mean") - bm["steps"]))
    z = scored.select("*", hr_z.alias("__hr_z"), spo2_z.alias("__spo2_z"), steps_z.alias("__steps_z"))
    composite = (F.col("__hr_z") * ANOMALY_WEIGHTS["heart_rate"] + F.col("__spo2_z") * ANOMALY_WEIGHTS["spo2"]
                 + F.col("__steps_z") * ANOMALY_WEIGHTS["steps"])
    scores = z.select(
        "*",
        F.col("__hr_z").try_cast("decimal(8,4)").alias("hr_zscore"),
        F.col("__spo2_z").try_cast("decimal(8,4)").alias("spo2_zscore"),
        F.col("__steps_z").try_cast("decimal(8,4)").alias("steps_zscore"),
        composite.try_cast("decimal(8,4)").alias("composite_anomaly_score"),
        (composite > flag_above).alias("anomaly_flag"),
        contributing_list([(F.col("__hr_z") > contrib_above, "heart_rate"),
                           (F.col("__spo2_z") > contrib_above, "spo2"),
                           (F.col("__steps_z") > contrib_above, "steps")]).alias("contributing_metrics"),
    )
    s, n = dec_sum_parts("composite_anomaly_score", 4)
    return scores.select(
        "*",
        dec_mean_from_parts(s.over(w7), n.over(w7), 4, 8).alias("avg_anomaly_score_7d"),
        F.sum(F.col("anomaly_flag").cast("int")).over(w.rowsBetween(-29, 0)).cast("int").alias("anomaly_events_30d"),
        F.max("anomaly_flag").over(w.rangeBetween(1, 1)).alias("__next_flag"),
    )


def anomaly_score(daily: DataFrame, load_ts=DEFAULT_LOAD_TS, scored: DataFrame | None = None) -> DataFrame:
    """bsat_anomaly_score (``scored``: a precomputed ``scored_days`` frame to share)."""
    return (scored if scored is not None else scored_days(daily)).select(
        "patient_hk", "report_date", load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_BUSINESS).alias("record_source"), "hr_zscore", "spo2_zscore", "steps_zscore",
        "composite_anomaly_score", "anomaly_flag", "contributing_metrics")


def _with_demographics(scored: DataFrame, sat_demo: DataFrame) -> DataFrame:
    demo = latest_demographics(sat_demo)
    flags = condition_flags(F.col("chronic_conditions"))
    demo = demo.select("patient_hk", "birth_date", "gender", "bmi", *[v.alias(k) for k, v in flags.items()])
    return scored.join(demo, "patient_hk", "inner")


def risk_days(daily: DataFrame, sat_demo: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Scored days joined to the latest demographics (the rows of the risk profile and the mart)."""
    j = _with_demographics(scored if scored is not None else scored_days(daily), sat_demo)
    return j.select("*", risk_tier(F.col("composite_anomaly_score")).alias("risk_tier"),
                    age_years("birth_date", "report_date").alias("age"))


def risk_profile(daily: DataFrame, sat_demo: DataFrame, load_ts=DEFAULT_LOAD_TS,
                 days: DataFrame | None = None) -> DataFrame:
    """bsat_patient_risk_profile. ``data_completeness_7d`` is the day's average completeness
    across metrics (the source's grouping makes it so, Q6)."""
    return (days if days is not None else risk_days(daily, sat_demo)).select(
        "patient_hk", "report_date", load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_BUSINESS).alias("record_source"), "age", "condition_count", "has_diabetes", "has_hypertension",
        "has_cardiac_condition", F.col("avg_anomaly_score_7d").cast("decimal(8,4)").alias("avg_anomaly_score_7d"),
        "anomaly_events_30d", F.col("data_completeness").cast("decimal(5,2)").alias("data_completeness_7d"),
        "risk_tier")


def daily_features(daily: DataFrame, sat_demo: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """mart_patient_daily_features (31 columns)."""
    def d(c, p, s):
        return F.col(c).cast(f"decimal({p},{s})").alias(c)
    return (days if days is not None else risk_days(daily, sat_demo)).select(
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
        F.coalesce(F.col("__next_flag"), F.lit(False)).alias("anomaly_next_24h"),
    )
