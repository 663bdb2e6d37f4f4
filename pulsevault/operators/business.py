"""Business vault (BV1-BV3): daily statistics, baseline anomaly scores, risk profiles.

Scale notes
* ``daily_stats`` is one hash aggregate over (patient, metric, day): count/sum/min/max/stddev
  and the percentile sketch all combine map-side, so only per-task partials are shuffled.
* ``anomaly_score`` replaces the source's 30x range self-join with a calendar range window
  (``rangeBetween(-30, -1)`` over the day number): no row blow-up, one sort per patient.
* All per-patient windows partition by ``patient_hk`` only; groups are patient histories at
  day grain (a few thousand rows even for a decade), never raw readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.fixed_values import (
    ANOMALY_BASELINE_DAYS, ANOMALY_CONTRIB_ABOVE, ANOMALY_FLAG_ABOVE, ANOMALY_WEIGHTS,
    EXPECTED_PER_DAY, RISK_TIERS, SNOMED_CARDIAC, SNOMED_DIABETES, SNOMED_HYPERTENSION, SRC_BUSINESS,
)
from pulsevault.functions import (
    age_years, contributing_list, day_number, dec_mean_from_parts, dec_sum_parts, round_ratio,
    surrogate_key,
)
from pulsevault.operators.staging import load_stamp, DEFAULT_LOAD_TS

PERCENTILE_ACCURACY = 10000


def expected_readings(metric: Column, count: Column) -> Column:
    """CASE2: expected readings per day for a metric; unknown metrics expect their own count."""
    expr = None
    for code, n in EXPECTED_PER_DAY.items():
        expr = F.when(metric == code, F.lit(n)) if expr is None else expr.when(metric == code, F.lit(n))
    return expr.otherwise(count)


def daily_stats(sat_reading_value: DataFrame, load_ts=DEFAULT_LOAD_TS, key: str = "patient_hk") -> DataFrame:
    """BV1 (AGG1, AGG2, CASE2, DT2): per patient x metric x calendar day.

    ``key="patient_id"`` groups staged readings by the business key and hashes it once per
    output group instead of once per reading (same rows; the hash is 1:1 with the key).
    """
    s, n = dec_sum_parts("value", 4)
    g = sat_reading_value.groupBy(
        key, "metric_code", F.to_date("measured_at").alias("report_date")
    ).agg(
        F.count(F.lit(1)).alias("reading_count"),
        s.alias("__s"), n.alias("__n"),
        F.stddev_samp("value").alias("__std"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
        F.percentile_approx("value", [0.5, 0.05, 0.95], PERCENTILE_ACCURACY).alias("__pct"),
    )
    return daily_columns(g, load_ts, F.col("patient_hk") if key == "patient_hk" else surrogate_key(key).alias("patient_hk"))


def daily_columns(g: DataFrame, load_ts, hk: Column) -> DataFrame:
    """The daily statistics from grouped counts, sums (__s, __n), __std, extremes and [median, p05, p95] (__pct)."""
    return g.select(
        hk, "metric_code", "report_date",
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_BUSINESS).alias("record_source"),
        F.col("reading_count"),
        dec_mean_from_parts("__s", "__n", 4, 10).alias("value_mean"),
        F.col("__std").cast("decimal(10,4)").alias("value_std"),
        F.col("value_min").cast("decimal(10,4)").alias("value_min"),
        F.col("value_max").cast("decimal(10,4)").alias("value_max"),
        F.col("__pct")[0].cast("decimal(10,4)").alias("value_median"),
        F.col("__pct")[1].cast("decimal(10,4)").alias("value_p05"),
        F.col("__pct")[2].cast("decimal(10,4)").alias("value_p95"),
        round_ratio(F.col("reading_count") * 100, expected_readings(F.col("metric_code"), F.col("reading_count")),
                    1, 5, 2).alias("completeness_pct"),
    )


# ---------------------------------------------------------------------------
# BV2 anomaly score
# ---------------------------------------------------------------------------

PIVOT = [("heart_rate", "hr"), ("spo2", "spo2"), ("steps", "steps")]


def anomaly_pivot(daily: DataFrame) -> DataFrame:
    """AGG6/FLT4: one row per patient-day with the three scored daily means."""
    return daily.where(F.col("metric_code").isin([m for m, _ in PIVOT])).groupBy("patient_hk", "report_date").agg(
        *[F.max(F.when(F.col("metric_code") == m, F.col("value_mean"))).alias(f"{p}_mean") for m, p in PIVOT]
    )


def baseline_30d(wide: DataFrame, days: int = ANOMALY_BASELINE_DAYS) -> DataFrame:
    """JN5/WIN7: prior-``days`` baseline (mean rounded like a decimal avg, sample stddev) per metric.

    Frame = rows with report_date in [d - days, d - 1]; days without any prior row are dropped
    (the inner self-join of the source drops them too).
    """
    w = Window.partitionBy("patient_hk").orderBy(day_number("report_date")).rangeBetween(-days, -1)
    out = wide.withColumn("__prior_rows", F.count(F.lit(1)).over(w))
    for _, p in PIVOT:
        s, n = dec_sum_parts(f"{p}_mean", 4)
        out = (out.withColumn(f"__{p}_s", s.over(w)).withColumn(f"__{p}_n", n.over(w))
               .withColumn(f"{p}_baseline_std", F.stddev_samp(F.col(f"{p}_mean").cast("double")).over(w)))
    out = out.where(F.col("__prior_rows") > 0)
    for _, p in PIVOT:
        out = out.withColumn(f"{p}_baseline_mean", dec_mean_from_parts(f"__{p}_s", f"__{p}_n", 4, 10))
    return out.drop("__prior_rows", *[f"__{p}_{x}" for _, p in PIVOT for x in ("s", "n")])


def zscores(base: DataFrame) -> DataFrame:
    """CASE5/MTH1: guarded z-scores. HR and steps absolute; SpO2 signed (baseline - today)."""
    def guarded(p: str, num: Column) -> Column:
        std = F.col(f"{p}_baseline_std")
        return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise(num.cast("double") / std)
    return base.select(
        "patient_hk", "report_date", "hr_mean", "spo2_mean", "steps_mean",
        guarded("hr", F.abs(F.col("hr_mean") - F.col("hr_baseline_mean"))).alias("hr_z"),
        guarded("spo2", F.col("spo2_baseline_mean") - F.col("spo2_mean")).alias("spo2_z"),
        guarded("steps", F.abs(F.col("steps_mean") - F.col("steps_baseline_mean"))).alias("steps_z"),
    )


def anomaly_score(daily: DataFrame, load_ts=DEFAULT_LOAD_TS, days: int = ANOMALY_BASELINE_DAYS,
                  flag_above: float = ANOMALY_FLAG_ABOVE, contrib_above: float = ANOMALY_CONTRIB_ABOVE) -> DataFrame:
    """BV2 (MTH3, STR2, CST2): pivot -> 30-day baseline -> z -> weighted composite, flag, contributors.

    Casts to decimal(8,4) are ``try_cast`` (NULL on overflow, S15); flag and contributors use
    the uncast doubles, as the source does.
    """
    z = zscores(baseline_30d(anomaly_pivot(daily), days))
    composite = (F.col("hr_z") * ANOMALY_WEIGHTS["heart_rate"] + F.col("spo2_z") * ANOMALY_WEIGHTS["spo2"]
                 + F.col("steps_z") * ANOMALY_WEIGHTS["steps"])
    return z.select(
        "patient_hk", "report_date",
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_BUSINESS).alias("record_source"),
        F.col("hr_z").try_cast("decimal(8,4)").alias("hr_zscore"),
        F.col("spo2_z").try_cast("decimal(8,4)").alias("spo2_zscore"),
        F.col("steps_z").try_cast("decimal(8,4)").alias("steps_zscore"),
        composite.try_cast("decimal(8,4)").alias("composite_anomaly_score"),
        (composite > flag_above).alias("anomaly_flag"),
        contributing_list([(F.col("hr_z") > contrib_above, "heart_rate"),
                           (F.col("spo2_z") > contrib_above, "spo2"),
                           (F.col("steps_z") > contrib_above, "steps")]).alias("contributing_metrics"),
    )


# ---------------------------------------------------------------------------
# BV3 risk profile
# ---------------------------------------------------------------------------


def condition_flags(chronic_conditions: Column) -> dict[str, Column]:
    """ARR1/ARR2/STR5: flags by code-set overlap and the count of non-empty codes."""
    codes = F.split(chronic_conditions, ",")

    def any_of(cs):
        return F.arrays_overlap(codes, F.array(*[F.lit(c) for c in cs]))
    return {
        "has_diabetes": any_of(SNOMED_DIABETES),
        "has_hypertension": any_of(SNOMED_HYPERTENSION),
        "has_cardiac_condition": any_of(SNOMED_CARDIAC),
        "condition_count": F.size(F.filter(codes, lambda c: c != "")).cast("long"),
    }


def latest_demographics(sat_demo: DataFrame) -> DataFrame:
    """WIN1: latest version per patient (one row; hash tie-break)."""
    from pulsevault.operators.vault import latest_version
    return latest_version(sat_demo, "patient_hk", keep_ties=False)


def risk_tier(score: Column, null_tier: str | None = "critical") -> Column:
    """CASE1: ordered tiers. A NULL score falls through to 'critical' like the source (S13);
    ``null_tier`` names another tier for it (or ``None`` to keep it NULL)."""
    expr = F.when(score.isNull(), F.lit(null_tier).cast("string"))
    for bound, name in RISK_TIERS:
        expr = expr.when(score < bound, name)
    return expr.otherwise("critical")


def rolling_anomaly(scores: DataFrame) -> DataFrame:
    """WIN3/WIN4/CST1: 7-row average score and 30-row anomaly-day count (row frames, Q17)."""
    w = Window.partitionBy("patient_hk").orderBy("report_date")
    s, n = dec_sum_parts("composite_anomaly_score", 4)
    return scores.select(
        "patient_hk", "report_date", "composite_anomaly_score", "anomaly_flag",
        dec_mean_from_parts(s.over(w.rowsBetween(-6, 0)), n.over(w.rowsBetween(-6, 0)), 4, 8)
        .alias("avg_anomaly_score_7d"),
        F.sum(F.col("anomaly_flag").cast("int")).over(w.rowsBetween(-29, 0)).cast("int").alias("anomaly_events_30d"),
    )


def completeness_7d(daily: DataFrame, scores: DataFrame, true_7d: bool = False) -> DataFrame:
    """JN6/AGG15: average completeness per (patient, vitals day) for vitals days that fall in
    [a - 6, a] of some scored day a.

    Literal (default): the source groups by the *vitals* day, so each value is that day's
    average across metrics (Q6). The range join is replaced by a bounded 7x fan-out of the
    score days (each score day names the seven vitals days it covers) and a semi join.
    ``true_7d=True`` averages the vitals days [d-6, d] instead (calendar range window).
    """
    per_day = daily.groupBy("patient_hk", "report_date").agg(
        F.sum((F.col("completeness_pct") * 100).cast("long")).alias("__s"),
        F.count("completeness_pct").alias("__n"))
    if true_7d:
        w = Window.partitionBy("patient_hk").orderBy(day_number("report_date")).rangeBetween(-6, 0)
        per_day = per_day.select("patient_hk", "report_date",
                                 F.sum("__s").over(w).alias("__s"), F.sum("__n").over(w).alias("__n"))
    covered = scores.select("patient_hk", F.explode(F.sequence(F.date_sub("report_date", 6), F.col("report_date")))
                            .alias("report_date"))
    return per_day.join(covered, ["patient_hk", "report_date"], "left_semi").select(
        "patient_hk", "report_date", dec_mean_from_parts("__s", "__n", 2, 5).alias("data_completeness_7d"))


def risk_profile(sat_demo: DataFrame, scores: DataFrame, daily: DataFrame, load_ts=DEFAULT_LOAD_TS,
                 true_7d: bool = False) -> DataFrame:
    """BV3: rolling anomaly x latest demographics ⟕ completeness."""
    demo = latest_demographics(sat_demo)
    flags = condition_flags(F.col("chronic_conditions"))
    demo = demo.select("patient_hk", "birth_date", *[v.alias(k) for k, v in flags.items()])
    ra = rolling_anomaly(scores)
    comp = completeness_7d(daily, scores, true_7d)
    j = ra.join(demo, "patient_hk", "inner").join(comp, ["patient_hk", "report_date"], "left")
    return j.select(
        "patient_hk", "report_date",
        load_stamp(load_ts).alias("load_datetime"),
        F.lit(SRC_BUSINESS).alias("record_source"),
        age_years("birth_date", "report_date").alias("age"),
        "condition_count", "has_diabetes", "has_hypertension", "has_cardiac_condition",
        F.col("avg_anomaly_score_7d").cast("decimal(8,4)").alias("avg_anomaly_score_7d"),
        "anomaly_events_30d",
        F.col("data_completeness_7d").cast("decimal(5,2)").alias("data_completeness_7d"),
        risk_tier(F.col("composite_anomaly_score")).alias("risk_tier"),
    )
