"""Query registry: key -> (spark, sf_dir) -> DataFrame, and key -> oracle SQL.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives from them) over
their whole extent. Keys follow SURVEY §2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsevault.plans import oracle as O
from pulsevault.plans.lakehouse import Lakehouse, lakehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Callable[[Lakehouse], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir, _fn=fn: _fn(lakehouse(spark, sf_dir))
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def layer(key: str, method: str | None = None, oracle_cte: str | None = None) -> None:
    """Register a lakehouse layer whose oracle is the library CTE of the same name."""
    m = method or key
    QUERIES[key] = lambda spark, sf_dir, _m=m: getattr(lakehouse(spark, sf_dir), _m)()
    ORACLE[key] = O.table(oracle_cte or m)


# -- layers: staging, vault, business, marts --------------------------------------------
for _k in ["stg_patients", "stg_conditions", "stg_readings", "stg_alerts",
           "hub_patient", "hub_reading", "hub_alert", "hub_device", "hub_metric_type",
           "lnk_patient_device", "lnk_device_metric", "lnk_reading_alert",
           "sat_reading_value", "sat_reading_context", "sat_alert_detail",
           "sat_patient_demographics", "sat_device_spec", "sat_metric_definition",
           "daily_vitals", "anomaly_score", "risk_profile",
           "mart_patient_daily_features", "mart_anomaly_dashboard", "breach_windows"]:
    layer(_k)

layer("breach_alerts", "raw_alerts", "raw_alerts")


# =====================================================================================
# Derived views of single operators
# =====================================================================================
from pulsevault.fixed_values import (  # noqa: E402
    EDA_CORR_FEATURES, MODEL_FEATURES, SNOMED_CARDIAC, SNOMED_DIABETES, SNOMED_HYPERTENSION, EDA_BOX_FEATURES,
)
from pulsevault.functions import age_years, parse_iso_ts, surrogate_key, dec_to_int  # noqa: E402
from pulsevault.operators import alerts as AL  # noqa: E402
from pulsevault.operators import business as BV  # noqa: E402
from pulsevault.operators import daystate as DS  # noqa: E402
from pulsevault.operators import marts as MT  # noqa: E402
from pulsevault.operators import ml as ML  # noqa: E402
from pulsevault.operators import patients as PT  # noqa: E402
from pulsevault.operators import quality as DQ  # noqa: E402
from pulsevault.operators import staging as ST  # noqa: E402
from pulsevault.operators import vault as DV  # noqa: E402
from pulsevault.plans import data_tests as T  # noqa: E402
from pulsevault.plans.oracle import AS_OF, LOAD_TS, key, sql  # noqa: E402
from pulsevault.sources import files as FS  # noqa: E402
from pulsevault.sources import sinks as SK  # noqa: E402
from pulsevault.session import scratch_path  # noqa: E402

ISO_SQL = "strftime(measured_at, '%Y-%m-%dT%H:%M:%S.%fZ')"
AS_OF_TS = "2024-01-31 00:00:00"


@register("flt_quality", sql("SELECT reading_id, quality_flag, metric_code, value FROM raw_readings "
                             "WHERE quality_flag != 'missing'", "raw_readings"))
def _flt_quality(lh):
    return ST.quality_filter(lh.raw_readings()).select("reading_id", "quality_flag", "metric_code", "value")


@register("fn_json_scalar", "SELECT CAST(event_id AS VARCHAR) AS reading_id, "
                            "json_extract_string(props, '$.k') AS k_text FROM events")
def _fn_json_scalar(lh):
    from pulsevault.functions import json_scalar
    return lh.feeds.table("events").select(F.col("event_id").cast("string").alias("reading_id"),
                                           json_scalar("props", "$.k").alias("k_text"))


@register("fn_iso_ts", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso_text, "
                       "CAST(ts AS TIMESTAMP) AS parsed FROM events")
def _fn_iso_ts(lh):
    iso = F.date_format("ts", SK.ISO_FORMAT)
    return lh.feeds.table("events").select("event_id", iso.alias("iso_text"), parse_iso_ts(iso).alias("parsed"))


@register("fn_surrogate_key", sql(f"SELECT reading_id, {key('reading_id')} AS k1, {key('patient_id', 'value')} AS k2, "
                                  f"{key('measured_at', 'activity_type')} AS k3 FROM stg_readings", "stg_readings"))
def _fn_surrogate_key(lh):
    return lh.stg_readings().select("reading_id", surrogate_key("reading_id").alias("k1"),
                                    surrogate_key("patient_id", "value").alias("k2"),
                                    surrogate_key("measured_at", "activity_type").alias("k3"))


@register("fn_age_years", sql(f"SELECT patient_id, birth_date, CAST({O.age('birth_date', AS_OF)} AS BIGINT) AS age "
                              "FROM stg_patients", "stg_patients"))
def _fn_age_years(lh):
    return lh.stg_patients().select("patient_id", "birth_date",
                                    age_years("birth_date", F.lit(lh.as_of).cast("date")).alias("age"))


@register("conditions_agg", O.table("conditions_agg"))
def _conditions_agg(lh):
    return DV.active_conditions(lh.stg_conditions())


@register("device_spec", sql(f"SELECT device_serial_bk, {O.device_case('device_serial_bk')} FROM hub_device",
                             "hub_device"))
def _device_spec(lh):
    model, maker = DV.device_model_of(F.col("device_serial_bk"))
    return lh.hub_device().select("device_serial_bk", model.alias("device_model"), maker.alias("manufacturer"))


@register("daily_percentiles", O.table("daily_vitals", "patient_hk, metric_code, report_date, value_median, "
                                                       "value_p05, value_p95"))
def _daily_percentiles(lh):
    return lh.daily_vitals().select("patient_hk", "metric_code", "report_date", "value_median", "value_p05",
                                    "value_p95")


@register("completeness", O.table("daily_vitals", "patient_hk, metric_code, report_date, reading_count, "
                                                  "completeness_pct"))
def _completeness(lh):
    return lh.daily_vitals().select("patient_hk", "metric_code", "report_date", "reading_count", "completeness_pct")


@register("anomaly_pivot", O.table("anomaly_pivot"))
def _anomaly_pivot(lh):
    return BV.anomaly_pivot(lh.daily_vitals())


_STD_COLS = ", ".join(f"CAST({p}_baseline_std AS DECIMAL(10,4)) AS {p}_baseline_std, {p}_baseline_mean"
                      for p in ("hr", "spo2", "steps"))


@register("baseline_30d", O.table("baseline_30d", f"patient_hk, report_date, hr_mean, spo2_mean, steps_mean, {_STD_COLS}"))
def _baseline_30d(lh):
    b = BV.baseline_30d(BV.anomaly_pivot(lh.daily_vitals()))
    cols = []
    for p in ("hr", "spo2", "steps"):
        cols += [F.col(f"{p}_baseline_std").cast("decimal(10,4)").alias(f"{p}_baseline_std"), f"{p}_baseline_mean"]
    return b.select("patient_hk", "report_date", "hr_mean", "spo2_mean", "steps_mean", *cols)


@register("zscore", O.table("zscore", "patient_hk, report_date, TRY_CAST(hr_z AS DECIMAL(18,4)) AS hr_z, "
                                      "TRY_CAST(spo2_z AS DECIMAL(18,4)) AS spo2_z, "
                                      "TRY_CAST(steps_z AS DECIMAL(18,4)) AS steps_z"))
def _zscore(lh):
    z = BV.zscores(BV.baseline_30d(BV.anomaly_pivot(lh.daily_vitals())))
    return z.select("patient_hk", "report_date",
                    *[F.col(c).try_cast("decimal(18,4)").alias(c) for c in ("hr_z", "spo2_z", "steps_z")])


@register("contributing_metrics", O.table("anomaly_score", "patient_hk, report_date, contributing_metrics"))
def _contributing(lh):
    return lh.anomaly_score().select("patient_hk", "report_date", "contributing_metrics")


@register("risk_tier", O.table("risk_profile", "patient_hk, report_date, risk_tier"))
def _risk_tier(lh):
    return lh.risk_profile().select("patient_hk", "report_date", "risk_tier")


@register("condition_flags", O.table("demo_flags", "patient_hk, has_diabetes, has_hypertension, "
                                                   "has_cardiac_condition, condition_count"))
def _condition_flags(lh):
    demo = BV.latest_demographics(lh.sat_patient_demographics())
    fl = BV.condition_flags(F.col("chronic_conditions"))
    return demo.select("patient_hk", *[v.alias(k) for k, v in fl.items()])


@register("rolling_7d", O.table("rolling_vitals", "patient_hk, report_date, hr_mean_7d_avg, spo2_min_7d_avg, "
                                                  "steps_total_7d_avg"))
def _rolling_7d(lh):
    return MT.rolling_vitals(MT.vitals_wide(lh.daily_vitals())).select(
        "patient_hk", "report_date", "hr_mean_7d_avg", "spo2_min_7d_avg", "steps_total_7d_avg")


@register("events_30d", O.table("rolling_anomaly", "patient_hk, report_date, avg_anomaly_score_7d, anomaly_events_30d"))
def _events_30d(lh):
    return BV.rolling_anomaly(lh.anomaly_score()).select("patient_hk", "report_date", "avg_anomaly_score_7d",
                                                         "anomaly_events_30d")


@register("completeness_7d", O.table("completeness_7d"))
def _completeness_7d(lh):
    return BV.completeness_7d(lh.daily_vitals(), lh.anomaly_score())


@register("latest_row", sql("SELECT patient_hk, report_date, risk_tier, avg_anomaly_score_7d, anomaly_events_30d FROM ("
                            "SELECT *, row_number() OVER (PARTITION BY patient_hk ORDER BY report_date DESC) rn "
                            "FROM risk_profile) x WHERE rn = 1", "risk_profile"))
def _latest_row(lh):
    return DV.latest_version(lh.risk_profile(), "patient_hk", "report_date", keep_ties=False).select(
        "patient_hk", "report_date", "risk_tier", "avg_anomaly_score_7d", "anomaly_events_30d")


_VW = ("patient_hk, report_date, hr_mean, hr_std, hr_min, hr_max, hr_p05, hr_p95, spo2_mean, spo2_min, "
       "CAST(steps_total AS DECIMAL(20,4)) AS steps_total, skin_temp_mean, glucose_mean, glucose_std, "
       "sleep_duration_hrs, data_completeness")


@register("vitals_wide", O.table("vitals_wide", _VW))
def _vitals_wide(lh):
    return MT.vitals_wide(lh.daily_vitals()).withColumn("steps_total", F.col("steps_total").cast("decimal(20,4)"))


@register("steps_total", sql("SELECT patient_hk, report_date, CAST(steps_total AS INTEGER) AS steps_total "
                             "FROM vitals_wide WHERE steps_total IS NOT NULL", "vitals_wide"))
def _steps_total(lh):
    return MT.vitals_wide(lh.daily_vitals()).where(F.col("steps_total").isNotNull()).select(
        "patient_hk", "report_date", dec_to_int("steps_total").alias("steps_total"))


@register("delta_1d", O.table("rolling_vitals", "patient_hk, report_date, hr_mean, "
                                                "CAST(hr_mean_delta_1d AS DECIMAL(11,4)) AS hr_mean_delta_1d"))
def _delta_1d(lh):
    return MT.rolling_vitals(MT.vitals_wide(lh.daily_vitals())).select(
        "patient_hk", "report_date", "hr_mean", F.col("hr_mean_delta_1d").cast("decimal(11,4)").alias("hr_mean_delta_1d"))


@register("label_next_day", O.table("label_next_day"))
def _label_next_day(lh):
    return MT.label_next_day(lh.anomaly_score())


@register("mart_features", sql("SELECT rv.patient_hk, rv.report_date, rv.hr_mean, r.risk_tier, a.composite_anomaly_score "
                               "FROM rolling_vitals rv JOIN risk_profile r ON r.patient_hk = rv.patient_hk AND "
                               "r.report_date = rv.report_date JOIN anomaly_score a ON a.patient_hk = rv.patient_hk "
                               "AND a.report_date = rv.report_date", "rolling_vitals", "risk_profile", "anomaly_score"))
def _mart_features(lh):
    rv = MT.rolling_vitals(MT.vitals_wide(lh.daily_vitals())).select("patient_hk", "report_date", "hr_mean")
    return (rv.join(lh.risk_profile().select("patient_hk", "report_date", "risk_tier"), ["patient_hk", "report_date"])
            .join(lh.anomaly_score().select("patient_hk", "report_date", "composite_anomaly_score"),
                  ["patient_hk", "report_date"]))


@register("dashboard", sql("SELECT patient_hk, report_date, composite_anomaly_score, contributing_metrics "
                           "FROM anomaly_score WHERE anomaly_flag = true", "anomaly_score"))
def _dashboard(lh):
    return lh.anomaly_score().where(F.col("anomaly_flag")).select("patient_hk", "report_date",
                                                                  "composite_anomaly_score", "contributing_metrics")


@register("join_inner", sql("SELECT hp.patient_bk, pd.gender, pd.birth_date, pd.chronic_conditions FROM "
                            "sat_patient_demographics pd JOIN hub_patient hp ON hp.patient_hk = pd.patient_hk",
                            "sat_patient_demographics", "hub_patient"))
def _join_inner(lh):
    return lh.sat_patient_demographics().join(lh.hub_patient(), "patient_hk").select(
        "patient_bk", "gender", "birth_date", "chronic_conditions")


@register("join_left", sql("SELECT p.patient_id, c.chronic_conditions FROM stg_patients p LEFT JOIN conditions_agg c "
                           "ON p.patient_id = c.patient_id", "stg_patients", "conditions_agg"))
def _join_left(lh):
    return lh.stg_patients().select("patient_id").join(DV.active_conditions(lh.stg_conditions()), "patient_id", "left")


@register("active_alerts", O.table("active_alerts"))
def _active_alerts(lh):
    return MT.active_alert_counts(lh.sat_alert_detail(), lh.hub_alert(), lh.lnk_reading_alert(), lh.sat_reading_value())


@register("latest_vital", O.table("latest_vital"))
def _latest_vital(lh):
    return MT.latest_vitals(lh.sat_reading_value())


@register("anomaly_trend", O.table("anomaly_trend"))
def _anomaly_trend(lh):
    return MT.anomaly_trend(lh.anomaly_score(), F.lit(lh.as_of).cast("date"))


@register("days_since_anomaly", O.table("days_since_anomaly"))
def _days_since(lh):
    return MT.days_since_anomaly(lh.anomaly_score(), F.lit(lh.as_of).cast("date"))


@register("breach_match", O.table("breach_match"))
def _breach_match(lh):
    return AL.breach_match(lh.stg_readings())


# -- patients (simulator loader) ------------------------------------------------------------------
_ENRICH_CTE = f"""
SELECT p.patient_id, row_number() OVER (ORDER BY p.patient_id) - 1 AS idx, p.birth_date, p.gender, p.race,
       p.ethnicity, p.city, p.state, p.bmi, coalesce(c.codes, CAST([] AS VARCHAR[])) AS codes
FROM stg_patients p LEFT JOIN (SELECT patient_id, list_sort(list(condition_code)) AS codes FROM stg_conditions
                               GROUP BY patient_id) c ON p.patient_id = c.patient_id"""
O.cte("enrich_base", ["stg_patients", "stg_conditions"], _ENRICH_CTE)
O.cte("patients_enriched", ["enrich_base"], f"""
SELECT patient_id, idx, birth_date, gender, race, ethnicity, city, state, bmi,
       array_to_string(codes, ',') AS chronic_conditions,
       list_has_any(codes, [{O.in_list(SNOMED_DIABETES)}]) AS has_diabetes,
       list_has_any(codes, [{O.in_list(SNOMED_HYPERTENSION)}]) AS has_hypertension,
       list_has_any(codes, [{O.in_list(SNOMED_CARDIAC)}]) AS has_cardiac_condition,
       printf('GRM-W%04d', idx) AS device_serial,
       CASE idx % 3 WHEN 0 THEN 'Garmin Venu 3' WHEN 1 THEN 'Apple Watch Ultra 2' ELSE 'Withings ScanWatch 2' END AS device_model,
       CASE idx % 3 WHEN 0 THEN 'Garmin' WHEN 1 THEN 'Apple' ELSE 'Withings' END AS device_manufacturer,
       CASE WHEN list_has_any(codes, [{O.in_list(SNOMED_DIABETES)}]) THEN printf('CGM-%04d', idx) END AS cgm_serial,
       CASE WHEN list_has_any(codes, [{O.in_list(SNOMED_DIABETES)}]) THEN 'Dexcom G7' END AS cgm_model,
       CASE WHEN list_has_any(codes, [{O.in_list(SNOMED_DIABETES)}]) THEN 'Dexcom' END AS cgm_manufacturer
FROM enrich_base""")


@register("patient_enrich", O.table("patients_enriched"))
def _patient_enrich(lh):
    return lh.patients_enriched()


@register("device_assign", O.table("patients_enriched", "patient_id, device_serial, device_model, device_manufacturer, "
                                                        "cgm_serial, cgm_model, cgm_manufacturer"))
def _device_assign(lh):
    return lh.patients_enriched().select("patient_id", "device_serial", "device_model", "device_manufacturer",
                                         "cgm_serial", "cgm_model", "cgm_manufacturer")


@register("metrics_supported", O.table("patients_enriched", "patient_id, 'heart_rate,spo2,steps,skin_temperature,"
                                                            "sleep_stage' || CASE WHEN has_diabetes THEN "
                                                            "',blood_glucose' ELSE '' END AS metrics_supported"))
def _metrics_supported(lh):
    m = PT.metrics_supported(lh.patients_enriched())
    return m.select("patient_id", F.array_join("metrics_supported", ",").alias("metrics_supported"))


# -- sets and top-k ------------------------------------------------------------------------------------
@register("set_union_feeds", sql("SELECT 'readings' AS feed, reading_id AS event_id, patient_id, measured_at AS event_ts "
                                 "FROM stg_readings UNION ALL SELECT 'alerts', alert_id, patient_id, triggered_at "
                                 "FROM raw_alerts", "stg_readings", "raw_alerts"))
def _set_union(lh):
    r = lh.stg_readings().select(F.lit("readings").alias("feed"), F.col("reading_id").alias("event_id"), "patient_id",
                                 F.col("measured_at").alias("event_ts"))
    a = lh.raw_alerts().select(F.lit("alerts").alias("feed"), F.col("alert_id").alias("event_id"), "patient_id",
                               F.col("triggered_at").alias("event_ts"))
    return r.unionByName(a)


@register("topk_recent", sql("SELECT * FROM mart_patient_daily_features ORDER BY report_date DESC, patient_hk LIMIT 10000",
                             "mart_patient_daily_features"))
def _topk_recent(lh):
    return ML.topk_recent(lh.mart_patient_daily_features())


@register("topk_patients", sql("SELECT patient_id, birth_date, gender FROM stg_patients ORDER BY patient_id LIMIT 100",
                               "stg_patients"))
def _topk_patients(lh):
    return lh.stg_patients().orderBy("patient_id").limit(100).select("patient_id", "birth_date", "gender")


# =====================================================================================
# Incremental loads and change detection (two loads derived from the same tables)
# =====================================================================================
LOAD1_TS = "2024-01-15 00:00:00"
ONSET_CUTOFF = "1995-01-01"


def _demographics_load1(lh: Lakehouse) -> DataFrame:
    """First load: the same patients, stamped earlier, knowing only conditions with onset before the cutoff."""
    p1 = ST.stg_patients(lh.raw_patients(), LOAD1_TS)
    c1 = ST.stg_conditions(lh.raw_conditions(), LOAD1_TS).where(F.col("onset_date") < F.lit(ONSET_CUTOFF).cast("date"))
    return DV.sat_patient_demographics(p1, c1)


O.cte("conditions_agg1", ["stg_conditions"], f"""
SELECT patient_id, array_to_string(list_sort(list(condition_code)), ',') AS chronic_conditions
FROM stg_conditions WHERE resolved_date IS NULL AND onset_date < DATE '{ONSET_CUTOFF}' GROUP BY patient_id""")
O.cte("sat_demo_load1", ["stg_patients", "conditions_agg1"], f"""
SELECT {key('patient_id')} AS patient_hk, TIMESTAMP '{LOAD1_TS}' AS load_datetime,
       {key('gender', 'city', 'state', 'zip', 'bmi', 'chronic_conditions')} AS hash_diff,
       TIMESTAMP '{LOAD1_TS}' AS effective_from, record_source, birth_date, gender, race, ethnicity, city, state, zip,
       bmi, chronic_conditions
FROM (SELECT p.*, coalesce(c.chronic_conditions, '') AS chronic_conditions
      FROM stg_patients p LEFT JOIN conditions_agg1 c ON p.patient_id = c.patient_id) x""")
O.cte("change_detect", ["sat_patient_demographics", "sat_demo_load1"], """
SELECT s.* FROM sat_patient_demographics s LEFT JOIN sat_demo_load1 l ON l.patient_hk = s.patient_hk
WHERE l.hash_diff IS NULL OR l.hash_diff != s.hash_diff""")
O.cte("demo_versions", ["sat_demo_load1", "change_detect"], """
SELECT * FROM sat_demo_load1 UNION ALL SELECT * FROM change_detect""")


@register("change_detect", O.table("change_detect"))
def _change_detect(lh):
    return DV.sat_patient_demographics(lh.stg_patients(), lh.stg_conditions(), existing=_demographics_load1(lh))


@register("latest_correlated", sql("SELECT * FROM demo_versions v WHERE v.effective_from = (SELECT max(s.effective_from) "
                                   "FROM demo_versions s WHERE s.patient_hk = v.patient_hk)", "demo_versions"))
def _latest_correlated(lh):
    load1 = _demographics_load1(lh)
    changes = DV.sat_patient_demographics(lh.stg_patients(), lh.stg_conditions(), existing=load1)
    return DV.latest_version(load1.unionByName(changes), "patient_hk", keep_ties=True)


_DAILY_STAMP = "CAST(CAST(measured_at AS DATE) + 1 AS TIMESTAMP)"


@register("inc_hwm", sql(f"SELECT {key('reading_id')} AS reading_hk, {_DAILY_STAMP} AS load_datetime, measured_at "
                         f"FROM stg_readings WHERE {_DAILY_STAMP} > (SELECT max({_DAILY_STAMP}) FROM stg_readings "
                         f"WHERE {_DAILY_STAMP} <= TIMESTAMP '2024-01-16 00:00:00')", "stg_readings"))
def _inc_hwm(lh):
    stage = ST.stg_readings(lh.raw_readings(), ST.daily_load_stamp)
    existing = DV.sat_reading_value(stage.where(F.col("load_datetime") <= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")))
    new = DV.watermark_filter(DV.sat_reading_value(stage), existing)
    return new.select("reading_hk", "load_datetime", "measured_at")


# the stored rows of two days are out of date: the last one is reprocessed, the one before is beyond the lookback
@register("inc_hwm_date", O.table("risk_profile", "* REPLACE (CASE WHEN report_date = DATE '2024-01-19' THEN 'stale' ELSE risk_tier END AS risk_tier)"))
def _inc_hwm_date(lh):
    risk, day = lh.risk_profile(), F.col("report_date")
    at = lambda d: F.lit(d).cast("date")
    existing = risk.where(day <= at("2024-01-20")).withColumn("risk_tier", F.when(day >= at("2024-01-19"), "stale").otherwise(F.col("risk_tier")))
    new = DV.date_watermark_filter(risk, existing)
    return DV.replace_by_key(existing, new, ["patient_hk", "report_date"])


# =====================================================================================
# Data quality
# =====================================================================================
def _union_sql(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _report_sql(model: str, test: str, counts: dict[str, str]) -> list[str]:
    return [f"SELECT '{model}' AS model, '{test}' AS test, '{c}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM {model}" for c, cond in counts.items()]


@register("dq_not_null", sql(_union_sql(sum([_report_sql(m, "not_null", {c: f"{c} IS NULL" for c in cs})
                                             for m, cs in T.NOT_NULL.items()], [])), *T.NOT_NULL))
def _dq_not_null(lh):
    return DQ._union([DQ.not_null_summary(getattr(lh, m)(), m, cs) for m, cs in T.NOT_NULL.items()])


def _unique_sql(model, cols):
    c = ", ".join(cols)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in cols)
    return (f"SELECT '{model}' AS model, 'unique' AS test, '{','.join(cols)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {model} WHERE {nn} GROUP BY {c} "
            f"HAVING count(*) > 1) d")


@register("dq_unique", sql(_union_sql([_unique_sql(m, c) for m, c in T.UNIQUE]),
                           *sorted({m for m, _ in T.UNIQUE})))
def _dq_unique(lh):
    return DQ._union([DQ.unique_summary(getattr(lh, m)(), m, c) for m, c in T.UNIQUE])


@register("dq_accepted_values", sql(_union_sql(sum([
    _report_sql(m, "accepted_values", {c: f"{c} IS NOT NULL AND {c} NOT IN ({O.in_list(v)})" for c, v in r.items()})
    for m, r in T.ACCEPTED.items()], [])), *T.ACCEPTED))
def _dq_accepted(lh):
    return DQ._union([DQ.accepted_values_summary(getattr(lh, m)(), m, r) for m, r in T.ACCEPTED.items()])


def _rel_sql(child, col, parent, pcol):
    return (f"SELECT '{child}' AS model, 'relationships:{parent}.{pcol}' AS test, '{col}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")


@register("dq_relationships", sql(_union_sql([_rel_sql(*r) for r in T.RELATIONSHIPS]),
                                  *sorted({r[0] for r in T.RELATIONSHIPS} | {r[2] for r in T.RELATIONSHIPS})))
def _dq_relationships(lh):
    return DQ._union([DQ.relationship_summary(getattr(lh, c)(), c, col, getattr(lh, p)(), p, pc)
                      for c, col, p, pc in T.RELATIONSHIPS])


@register("dq_between", sql(_union_sql(sum([
    _report_sql(m, "between", {c: f"{c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})" for c, (lo, hi) in r.items()})
    for m, r in T.BETWEEN.items()], [])), *T.BETWEEN))
def _dq_between(lh):
    return DQ._union([DQ.between_summary(getattr(lh, m)(), m, r) for m, r in T.BETWEEN.items()])


@register("dq_range", sql("SELECT 'assert_hr_in_range' AS test, reading_hk, patient_hk, measured_at, value, quality_flag, "
                          "load_datetime FROM sat_reading_value WHERE metric_code = 'heart_rate' AND (value < 20 OR "
                          "value > 300) UNION ALL SELECT 'assert_spo2_in_range', reading_hk, patient_hk, measured_at, "
                          "value, quality_flag, load_datetime FROM sat_reading_value WHERE metric_code = 'spo2' AND "
                          "(value < 70 OR value > 100)", "sat_reading_value"))
def _dq_range(lh):
    return DQ.range_violations(lh.sat_reading_value())


_HOURS = "((epoch_us(TIMESTAMP '{now}') - epoch_us({t})) // 3600000000)"


@register("dq_freshness", sql(
    "SELECT d.device_hk, d.device_serial_bk, l.last_seen_at, "
    f"CAST({_HOURS.format(now=AS_OF_TS, t='l.last_seen_at')} AS BIGINT) AS hours_since_last_reading "
    "FROM hub_device d JOIN (SELECT device_hk, max(measured_at) AS last_seen_at FROM sat_reading_value GROUP BY device_hk) l "
    f"ON l.device_hk = d.device_hk WHERE {_HOURS.format(now=AS_OF_TS, t='l.last_seen_at')} > 25",
    "hub_device", "sat_reading_value"))
def _dq_freshness(lh):
    return DQ.stale_devices(lh.sat_reading_value(), lh.hub_device(), AS_OF_TS)


# devices whose serial ends in 3 fall silent on January 25
O.cte("heard_readings", ["sat_reading_value", "hub_device"], """
SELECT r.* FROM sat_reading_value r JOIN hub_device d ON d.device_hk = r.device_hk
WHERE NOT (right(d.device_serial_bk, 1) = '3' AND r.measured_at >= TIMESTAMP '2024-01-25 00:00:00')""")


@register("dq_silent_devices", sql(
    "SELECT d.device_hk, d.device_serial_bk, l.last_seen_at, "
    f"CAST({_HOURS.format(now=AS_OF_TS, t='l.last_seen_at')} AS BIGINT) AS hours_since_last_reading "
    "FROM hub_device d JOIN (SELECT device_hk, max(measured_at) AS last_seen_at FROM heard_readings GROUP BY device_hk) l "
    f"ON l.device_hk = d.device_hk WHERE {_HOURS.format(now=AS_OF_TS, t='l.last_seen_at')} > 25",
    "hub_device", "heard_readings"))
def _dq_silent_devices(lh):
    silent = lh.hub_device().where(F.col("device_serial_bk").endswith("3")).select("device_hk", F.lit(True).alias("silent"))
    heard = lh.sat_reading_value().join(silent, "device_hk", "left").where(
        F.col("silent").isNull() | (F.col("measured_at") < F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")))
    return DQ.stale_devices(heard, lh.hub_device(), AS_OF_TS)


@register("dq_source_freshness", sql(
    f"SELECT max_loaded_at, CAST({_HOURS.format(now=AS_OF_TS, t='max_loaded_at')} AS BIGINT) AS hours_since, "
    f"CASE WHEN max_loaded_at IS NULL OR {_HOURS.format(now=AS_OF_TS, t='max_loaded_at')} > 50 THEN 'error' "
    f"WHEN {_HOURS.format(now=AS_OF_TS, t='max_loaded_at')} > 26 THEN 'warn' ELSE 'pass' END AS status "
    "FROM (SELECT max(measured_at) AS max_loaded_at FROM stg_readings) m", "stg_readings"))
def _dq_source_freshness(lh):
    return DQ.source_freshness(lh.stg_readings(), AS_OF_TS)


# the schedule's load dates, given apart from what landed: the feeds start a day later and end a day earlier
FIRST_LOAD, LAST_LOAD = "2023-12-31", "2024-01-31"
O.cte("load_days", [], f"SELECT CAST(g.d AS DATE) AS d FROM generate_series(DATE '{FIRST_LOAD}', DATE '{LAST_LOAD}', INTERVAL 1 DAY) g(d)")
O.cte("found", ["raw_readings", "raw_alerts"], """
SELECT DISTINCT CAST(measured_at AS DATE) AS d, 'readings' AS feed FROM raw_readings
UNION SELECT DISTINCT CAST(triggered_at AS DATE), 'alerts' FROM raw_alerts""")


@register("dq_feeds_present", sql(
    "SELECT c.d, c.feed, coalesce(f.present, false) AS present FROM "
    "(SELECT d, x.feed FROM load_days, (VALUES ('readings'), ('alerts')) x(feed)) c "
    "LEFT JOIN (SELECT DISTINCT d, feed, true AS present FROM found) f ON f.d = c.d AND f.feed = c.feed",
    "load_days", "found"))
def _dq_feeds_present(lh):
    lines = {"readings": lh.spark.read.text(lh.landing_readings()), "alerts": lh.spark.read.text(lh.landing_alerts())}
    return DQ.feeds_present(DQ.expected_days(lh.spark, FIRST_LOAD, LAST_LOAD), lines)


@register("dq_min_rows", sql("SELECT l.d, count(r.measured_at) AS line_count, count(r.measured_at) >= 100 AS passed FROM load_days l "
                             "LEFT JOIN raw_readings r ON CAST(r.measured_at AS DATE) = l.d GROUP BY l.d", "load_days", "raw_readings"))
def _dq_min_rows(lh):
    return DQ.min_rows_per_day(DQ.expected_days(lh.spark, FIRST_LOAD, LAST_LOAD), lh.spark.read.text(lh.landing_readings()))


# Readings that break one rule of each kind in a known way: ids that end in 7 lose their value, in 5 get an
# unknown quality flag, in 3 come twice, and the parent table lacks those that end in 9.
O.cte("broken_readings", ["stg_readings"], """
SELECT reading_id, CASE WHEN right(reading_id, 1) = '7' THEN NULL ELSE value END AS value,
       CASE WHEN right(reading_id, 1) = '5' THEN 'unknown' ELSE quality_flag END AS quality_flag FROM stg_readings
UNION ALL SELECT reading_id, value, quality_flag FROM stg_readings WHERE right(reading_id, 1) = '3'""")
O.cte("some_readings", ["stg_readings"], "SELECT reading_id FROM stg_readings WHERE right(reading_id, 1) <> '9'")


@register("dq_failing_rules", sql(_union_sql(
    _report_sql("broken_readings", "not_null", {"value": "value IS NULL"}) + [_unique_sql("broken_readings", ["reading_id"])]
    + _report_sql("broken_readings", "accepted_values",
                  {"quality_flag": "quality_flag IS NOT NULL AND quality_flag NOT IN ('good', 'noisy', 'interpolated')"})
    + [_rel_sql("broken_readings", "reading_id", "some_readings", "reading_id")]
    + _report_sql("broken_readings", "between", {"value": "value IS NOT NULL AND NOT (value BETWEEN 20 AND 60)"})),
    "broken_readings", "some_readings"))
def _dq_failing_rules(lh):
    r = lh.stg_readings().select("reading_id", "value", "quality_flag")
    last = F.substring("reading_id", -1, 1)
    broken = r.select("reading_id", F.when(last != "7", F.col("value")).alias("value"),
                      F.when(last == "5", "unknown").otherwise(F.col("quality_flag")).alias("quality_flag"))
    broken = broken.unionByName(r.where(last == "3"))
    name = "broken_readings"
    return DQ._union([
        DQ.not_null_summary(broken, name, ["value"]), DQ.unique_summary(broken, name, ["reading_id"]),
        DQ.accepted_values_summary(broken, name, {"quality_flag": ["good", "noisy", "interpolated"]}),
        DQ.relationship_summary(broken, name, "reading_id", r.where(last != "9"), "some_readings", "reading_id"),
        DQ.between_summary(broken, name, {"value": (20, 60)})])


# =====================================================================================
# ML / EDA over the feature mart
# =====================================================================================
MART = "mart_patient_daily_features"


@register("eda_profile", sql(
    f"SELECT count(*) AS n_rows, CAST(31 AS BIGINT) AS n_cols, count(*) FILTER (WHERE anomaly_next_24h) AS n_positive, "
    f"round(count(*) FILTER (WHERE anomaly_next_24h) / count(*), 6) AS anomaly_rate, min(report_date) AS min_date, "
    f"max(report_date) AS max_date, count(DISTINCT patient_hk) AS n_patients FROM {MART}", MART))
def _eda_profile(lh):
    return ML.profile(lh.mart_patient_daily_features())


_DESCRIBE_COLS = EDA_CORR_FEATURES


@register("eda_describe", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(CAST({c} AS DOUBLE)) AS n, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, min(CAST({c} AS DOUBLE)) AS min, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.{q}), 6) AS q{q}" for q in (25, 50, 75)) + f", max(CAST({c} AS DOUBLE)) AS max "
    f"FROM {MART}" for c in _DESCRIBE_COLS), MART))
def _eda_describe(lh):
    d = ML.describe(lh.mart_patient_daily_features(), _DESCRIBE_COLS)
    return d.select("column_name", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], "max")


_MART_TYPES = {
    "patient_hk": "string", "report_date": "date", "age": "bigint", "gender": "string", "bmi": "decimal(5,2)", "has_diabetes": "boolean",
    "has_hypertension": "boolean", "has_cardiac_condition": "boolean", "condition_count": "bigint", "steps_total": "int",
    "sleep_duration_hrs": "decimal(6,2)", "steps_total_7d_avg": "decimal(10,2)", "anomaly_events_30d": "int",
    "data_completeness": "decimal(5,2)", "risk_tier": "string", "anomaly_next_24h": "boolean",
    **dict.fromkeys(["hr_mean", "hr_std", "hr_min", "hr_max", "hr_p05", "hr_p95", "spo2_mean", "spo2_min", "skin_temp_mean", "glucose_mean",
                     "glucose_std", "hr_mean_7d_avg", "hr_mean_delta_1d", "spo2_min_7d_avg", "composite_anomaly_score"], "decimal(8,4)")}


@register("eda_info", sql(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS n_known FROM {MART}"
                                             for c, t in _MART_TYPES.items()), MART))
def _eda_info(lh):
    return ML.column_info(lh.mart_patient_daily_features())


@register("eda_label_counts", sql(f"SELECT anomaly_next_24h, count(*) AS n FROM {MART} GROUP BY 1", MART))
def _eda_label_counts(lh):
    return ML.label_counts(lh.mart_patient_daily_features())


@register("eda_rate_by_tier", sql(
    f"SELECT risk_tier, count(*) AS n, count(*) FILTER (WHERE anomaly_next_24h) AS positives, "
    f"round(count(*) FILTER (WHERE anomaly_next_24h) / count(*), 6) AS rate FROM {MART} GROUP BY 1", MART))
def _eda_rate_by_tier(lh):
    return ML.rate_by_tier(lh.mart_patient_daily_features())


_BOX_LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, anomaly_next_24h AS label, CAST({f} AS DECIMAL(12,4)) AS value FROM {MART} "
    f"WHERE {f} IS NOT NULL" for f in EDA_BOX_FEATURES)
O.cte("box_long", [MART], _BOX_LONG)
O.cte("box_q", ["box_long"], """
SELECT feature, label, count(*) AS n, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS median,
       quantile_disc(value, 0.75) AS q3 FROM box_long GROUP BY feature, label""")


@register("eda_boxplot", sql(
    "SELECT q.feature, q.label, q.n, q.q1, q.median, q.q3, "
    "CAST(min(CASE WHEN l.value BETWEEN q.q1 - (q.q3 - q.q1) * 1.5 AND q.q3 + (q.q3 - q.q1) * 1.5 THEN l.value END) "
    "AS DECIMAL(12,4)) AS whisker_low, "
    "CAST(max(CASE WHEN l.value BETWEEN q.q1 - (q.q3 - q.q1) * 1.5 AND q.q3 + (q.q3 - q.q1) * 1.5 THEN l.value END) "
    "AS DECIMAL(12,4)) AS whisker_high, "
    "count(*) FILTER (WHERE NOT (l.value BETWEEN q.q1 - (q.q3 - q.q1) * 1.5 AND q.q3 + (q.q3 - q.q1) * 1.5)) AS n_outliers "
    "FROM box_q q JOIN box_long l ON l.feature = q.feature AND l.label = q.label "
    "GROUP BY q.feature, q.label, q.n, q.q1, q.median, q.q3", "box_q", "box_long"))
def _eda_boxplot(lh):
    return ML.boxplot_stats(lh.mart_patient_daily_features())


_CORR_COLS = EDA_CORR_FEATURES + ["anomaly_next_24h"]
_CORR_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]


@register("eda_corr", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr "
    f"FROM {MART}" for a, b in _CORR_PAIRS), MART))
def _eda_corr(lh):
    return ML.correlations(lh.mart_patient_daily_features())


_ML_COLS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)
_ML_NN = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES + ["anomaly_next_24h"])
O.cte("ml_dataset", [MART], f"SELECT patient_hk, report_date, {_ML_COLS}, CAST(anomaly_next_24h AS INTEGER) AS label "
                            f"FROM {MART} WHERE {_ML_NN}")


@register("ml_dataset", O.table("ml_dataset"))
def _ml_dataset(lh):
    return ML.model_dataset(lh.mart_patient_daily_features())


@register("ml_split", sql(
    "SELECT patient_hk, report_date, label, CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', patient_hk, "
    "CAST(report_date AS VARCHAR), CAST(label AS VARCHAR))), 1, 8)) AS BIGINT) % 100 < 80 THEN 'train' "
    "ELSE 'test' END AS split FROM ml_dataset", "ml_dataset"))
def _ml_split(lh):
    return ML.stratified_split(ML.model_dataset(lh.mart_patient_daily_features())).select(
        "patient_hk", "report_date", "label", "split")


_MODELS: dict = {}


def _model(lh: Lakehouse):
    k = (lh.spark.sparkContext.applicationId, id(lh.spark), lh.sf_dir)
    if k not in _MODELS:
        split = ML.stratified_split(ML.model_dataset(lh.mart_patient_daily_features()))
        split = lh.materialize(split, "ml-split")
        asm, model = ML.train_forest(split)
        _MODELS[k] = (split, asm, model)
    return _MODELS[k]


@register("ml_forest")
def _ml_forest(lh):
    split, asm, model = _model(lh)
    return ML.predict(asm, model, split)


@register("ml_metrics")
def _ml_metrics(lh):
    split, asm, model = _model(lh)
    return ML.classification_metrics(ML.predict(asm, model, split))


O.cte("ml_test", ["ml_dataset"], "SELECT patient_hk, report_date, label FROM ml_dataset WHERE CAST(('0x' || substr(md5(concat_ws('|', "
      "patient_hk, CAST(report_date AS VARCHAR), CAST(label AS VARCHAR))), 1, 8)) AS BIGINT) % 100 >= 80")


# what SQL can state of the model's outputs: which rows are predicted, the support of each class, the feature names
@register("ml_predicted_rows", O.table("ml_test"))
def _ml_predicted_rows(lh):
    split, asm, model = _model(lh)
    return ML.predict(asm, model, split).select("patient_hk", "report_date", "label")


@register("ml_support", sql("SELECT CAST(c.label AS VARCHAR) AS metric_group, count(t.label) AS support FROM (VALUES (0), (1)) c(label) "
                            "LEFT JOIN ml_test t ON t.label = c.label GROUP BY c.label", "ml_test"))
def _ml_support(lh):
    split, asm, model = _model(lh)
    return ML.classification_metrics(ML.predict(asm, model, split)).where(F.col("metric_group").isin("0", "1")).select("metric_group", "support")


@register("ml_features", sql("SELECT f.feature FROM (VALUES " + ", ".join(f"('{f}')" for f in MODEL_FEATURES) + ") f(feature) "
                             "WHERE EXISTS (SELECT 1 FROM ml_dataset)", "ml_dataset"))
def _ml_features(lh):
    _, _, model = _model(lh)
    return ML.feature_importances(model, top=len(MODEL_FEATURES)).select("feature")


# predictions that follow from the row's key, so that every number of the report can be stated
_RULE = "CAST(('0x' || substr(md5(concat_ws('|', patient_hk, CAST(report_date AS VARCHAR))), 1, 8)) AS BIGINT) % 10"
O.cte("ruled", ["ml_dataset"], f"SELECT label, CASE WHEN {_RULE} < 2 THEN 1 - label ELSE label END AS prediction, "
      f"CAST(({_RULE}) * 10 + label AS DOUBLE) / 100 AS p_positive FROM ml_dataset")
_CLASS = " UNION ALL ".join(
    f"SELECT '{c}' AS metric_group, count(*) FILTER (WHERE prediction = {c} AND label = {c}) AS tp, count(*) FILTER (WHERE prediction = {c}) AS pp, "
    f"count(*) FILTER (WHERE label = {c}) AS support FROM ruled" for c in (0, 1))
O.cte("ruled_classes", ["ruled"], f"""
SELECT metric_group, support, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
FROM ({_CLASS}) c""")
O.cte("ruled_report", ["ruled_classes"], """
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM ruled_classes""")
O.cte("ruled_auc", ["ruled"], """
SELECT (sum(CASE WHEN label = 1 THEN rank END) - (p * (p + 1)) / 2) / (p * n) AS auc FROM (
  SELECT label, (rank() OVER (ORDER BY p_positive) + rank() OVER (ORDER BY p_positive) + count(*) OVER (PARTITION BY p_positive) - 1) / 2 AS rank,
         count(*) FILTER (WHERE label = 1) OVER () AS p, count(*) FILTER (WHERE label = 0) OVER () AS n FROM ruled) r GROUP BY p, n""")


@register("ml_report_of_rules", sql(
    "SELECT metric_group, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM ruled_report "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM ruled_report "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), "
    "round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM ruled_report "
    "UNION ALL SELECT 'accuracy', round(count(*) FILTER (WHERE prediction = label) / count(*), 9), NULL, NULL, count(*) FROM ruled "
    "UNION ALL SELECT 'roc_auc', (SELECT round(auc, 9) FROM ruled_auc), NULL, NULL, NULL", "ruled", "ruled_report", "ruled_auc"))
def _ml_report_of_rules(lh):
    d = ML.model_dataset(lh.mart_patient_daily_features())
    rule = F.conv(F.substring(F.md5(F.concat_ws("|", "patient_hk", F.col("report_date").cast("string"))), 1, 8), 16, 10).cast("long") % 10
    pred = d.select("label", F.when(rule < 2, 1 - F.col("label")).otherwise(F.col("label")).alias("prediction"),
                    ((rule * 10 + F.col("label")).cast("double") / 100).alias("p_positive"))
    report = ML.classification_metrics(pred)
    return report.select("metric_group", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("ml_importance")
def _ml_importance(lh):
    _, _, model = _model(lh)
    return ML.feature_importances(model)


# =====================================================================================
# Sources and sinks: round trips through files Spark writes from the tables
# =====================================================================================
PATIENT_HEADER = {"id": "Id", "birthdate": "BIRTHDATE", "first": "FIRST", "last": "LAST", "race": "RACE",
                  "ethnicity": "ETHNICITY", "gender": "GENDER", "city": "CITY", "state": "STATE", "zip": "ZIP",
                  "bmi": "BMI"}
CONDITION_HEADER = {c: c.upper() for c in ["start", "stop", "patient", "encounter", "code", "description"]}


@register("src_patients", O.table("stg_patients"))
def _src_patients(lh):
    path = scratch_path(lh.spark, "patients-csv")
    SK.write_csv(lh.raw_patients(), path, PATIENT_HEADER)
    return ST.stg_patients(FS.read_patients(lh.spark, path), lh.load_ts)


@register("src_conditions", O.table("stg_conditions"))
def _src_conditions(lh):
    path = scratch_path(lh.spark, "conditions-csv")
    SK.write_csv(lh.raw_conditions(), path, CONDITION_HEADER)
    return ST.stg_conditions(FS.read_conditions(lh.spark, path), lh.load_ts)


@register("src_readings", O.table("stg_readings"))
def _src_readings(lh):
    return ST.stg_readings(FS.read_readings(lh.spark, lh.landing_readings()), lh.load_ts)


@register("src_alerts", O.table("stg_alerts"))
def _src_alerts(lh):
    return ST.stg_alerts(FS.read_alerts(lh.spark, lh.landing_alerts()), lh.load_ts)


_RAW_ISO = ("reading_id, patient_id, device_serial, metric_code, value, unit, quality_flag, "
            f"{ISO_SQL} AS measured_at, context")


@register("sink_ndjson", O.table("raw_readings", _RAW_ISO))
def _sink_ndjson(lh):
    return FS.read_readings(lh.spark, lh.landing_readings())


@register("src_day_slice", sql(f"SELECT {_RAW_ISO} FROM raw_readings WHERE CAST(measured_at AS DATE) = DATE '2024-01-30'",
                               "raw_readings"))
def _src_day_slice(lh):
    return FS.read_day_slice(lh.spark, lh.landing_readings(), "2024-01-30")


@register("load_append", sql(f"SELECT {key('patient_id')} AS patient_hk, patient_id AS patient_bk, CASE WHEN birth_date < "
                             f"DATE '1970-01-01' THEN TIMESTAMP '{LOAD1_TS}' ELSE {LOAD_TS} END AS load_datetime, "
                             "'synthea' AS record_source FROM stg_patients", "stg_patients"))
def _load_append(lh):
    path = scratch_path(lh.spark, "hub-patient")
    first = ST.stg_patients(lh.raw_patients(), LOAD1_TS).where(F.col("birth_date") < F.lit("1970-01-01").cast("date"))
    SK.append_new(lh.spark, DV.hub_patient(first), path, ["patient_hk"])
    # second load: everyone again; only keys not yet in the hub are appended
    return SK.append_new(lh.spark, DV.hub_patient(lh.stg_patients()), path, ["patient_hk"])


_SRV_DAY = "*, CAST(measured_at AS DATE) AS measured_date"


@register("sink_partitioned", O.table("sat_reading_value", _SRV_DAY))
def _sink_partitioned(lh):
    path = scratch_path(lh.spark, "sat-reading-value")
    SK.write_partitioned_by_day(lh.sat_reading_value(), path)
    return lh.spark.read.parquet(path)


@register("compact_daily", O.table("sat_reading_value", _SRV_DAY))
def _compact_daily(lh):
    path = scratch_path(lh.spark, "srv-small-files")
    rows = lh.sat_reading_value().withColumn("measured_date", F.to_date("measured_at"))
    # even days as one load leaves them, odd days in many small files, as a stream of appends leaves behind
    even = F.dayofmonth("measured_date") % 2 == 0
    rows.where(even).repartition("measured_date").write.partitionBy("measured_date").parquet(path)
    rows.where(~even).repartition(8).write.mode("append").partitionBy("measured_date").parquet(path)
    SK.compact_small_files(lh.spark, path, "measured_date")
    return lh.spark.read.parquet(path)


@register("snapshot_read", sql(f"SELECT * FROM {MART} WHERE report_date < DATE '2024-01-20'", MART))
def _snapshot_read(lh):
    root = scratch_path(lh.spark, "mart-snapshots")
    mart = lh.mart_patient_daily_features()
    v1 = SK.write_snapshot(lh.spark, mart.where(F.col("report_date") < F.lit("2024-01-20").cast("date")), root)
    SK.write_snapshot(lh.spark, mart, root)
    return SK.read_snapshot(lh.spark, root, v1)


# =====================================================================================
# Structured Streaming slice
# =====================================================================================
@register("stream_daily_stats", sql("SELECT patient_id, metric_code, CAST(measured_at AS DATE) AS report_date, "
                                    "count(*) AS reading_count, min(value) AS value_min, max(value) AS value_max "
                                    "FROM stg_readings GROUP BY 1, 2, 3", "stg_readings"))
def _stream_daily_stats(lh):
    from pulsevault.streaming.readings import stream_daily_stats
    # several micro-batches (5 day-files each); the watermark is wide enough that no day is late
    return stream_daily_stats(lh.spark, lh.landing_readings(), lh.load_ts, watermark="40 days",
                              max_files_per_trigger=5)


# =====================================================================================
# The daily batch in two runs (first half of the month, then the rest) == one full load
# =====================================================================================
BATCH_SPLIT = "2024-01-15"


def _two_batches(lh: Lakehouse):
    from pulsevault.plans.batch import Warehouse, run_daily_batch
    key = "two_batches"
    if key not in lh.scenarios:
        wh = Warehouse(lh.spark, scratch_path(lh.spark, "warehouse"))
        day = F.to_date("measured_at")
        split = F.lit(BATCH_SPLIT).cast("date")
        run_daily_batch(lh.spark, wh, lh.raw_readings().where(day <= split), lh.raw_patients(), lh.raw_conditions(),
                        "2024-01-16 00:00:00")
        run_daily_batch(lh.spark, wh, lh.raw_readings().where(day > split), lh.raw_patients(), lh.raw_conditions(),
                        lh.load_ts)
        lh.scenarios[key] = wh
    return lh.scenarios[key]


@register("batch_mart", O.table(MART))
def _batch_mart(lh):
    return _two_batches(lh).read(MART)


_BATCH_STAMP = (f"CASE WHEN CAST(measured_at AS DATE) <= DATE '{BATCH_SPLIT}' THEN TIMESTAMP '2024-01-16 00:00:00' "
                f"ELSE {LOAD_TS} END")


@register("batch_hub_reading", sql(f"SELECT {key('reading_id')} AS reading_hk, reading_id AS reading_id_bk, "
                                   f"{_BATCH_STAMP} AS load_datetime, 'wearable_simulator' AS record_source "
                                   "FROM stg_readings", "stg_readings"))
def _batch_hub_reading(lh):
    return _two_batches(lh).read("hub_reading")


@register("batch_daily_vitals", sql("SELECT * EXCLUDE (load_datetime), "
                                    "CASE WHEN report_date <= DATE '2024-01-15' THEN TIMESTAMP '2024-01-16 00:00:00' "
                                    f"ELSE {LOAD_TS} END AS load_datetime FROM daily_vitals", "daily_vitals"))
def _batch_daily_vitals(lh):
    return _two_batches(lh).read("daily_vitals")


@register("batch_sat_reading_value", sql(f"SELECT * EXCLUDE (load_datetime), {_BATCH_STAMP} AS load_datetime FROM sat_reading_value",
                                         "sat_reading_value"))
def _batch_sat_reading_value(lh):
    return _two_batches(lh).read("sat_reading_value")


@register("batch_latest_vital", O.table("latest_vital"))
def _batch_latest_vital(lh):
    return DS.latest_from_state(_two_batches(lh).read("patient_state"))


@register("batch_active_alerts", O.table("active_alerts"))
def _batch_active_alerts(lh):
    wh = _two_batches(lh)
    # the value satellite is bucketed by reading key: only the links are shuffled
    return MT.active_alert_counts(wh.read("sat_alert_detail"), wh.read("hub_alert"), wh.read("lnk_reading_alert"), wh.read("sat_reading_value"))


@register("batch_alert_state", O.table("active_alerts"))
def _batch_alert_state(lh):
    return DS.alerts_from_state(_two_batches(lh).read("patient_state"))


@register("batch_dashboard", O.table("mart_anomaly_dashboard"))
def _batch_dashboard(lh):
    return _two_batches(lh).read("mart_anomaly_dashboard")


_APPENDED = ["hub_patient", "hub_device", "hub_metric_type", "hub_reading", "hub_alert", "lnk_patient_device", "lnk_device_metric",
             "lnk_reading_alert", "sat_patient_demographics", "sat_device_spec", "sat_reading_value", "sat_reading_context", "sat_alert_detail"]
_OBSERVED = [r for m in _APPENDED for r in
             _report_sql(m, "not_null", {c: f"{c} IS NULL" for c in T.NOT_NULL.get(m, [])})
             + _report_sql(m, "accepted_values", {c: f"{c} IS NOT NULL AND {c} NOT IN ({O.in_list(v)})" for c, v in T.ACCEPTED.get(m, {}).items()})
             + _report_sql(m, "between", {c: f"{c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})" for c, (lo, hi) in T.BETWEEN.get(m, {}).items()})]


@register("batch_data_tests", sql(_union_sql([r.replace("AS failures FROM", "AS failures, CAST(count(*) AS BIGINT) AS n_rows FROM") for r in _OBSERVED]), *_APPENDED))
def _batch_data_tests(lh):
    seen = _two_batches(lh).read("data_tests").where(F.col("model").isin(_APPENDED))
    return seen.groupBy("model", "test", "column_name").agg(F.sum("failures").alias("failures"), F.sum("n_rows").alias("n_rows"))


@register("stream_breach_alerts", O.table("raw_alerts"))
def _stream_breach_alerts(lh):
    from pulsevault.streaming.alerts import stream_breach_alerts
    # the feed is complete up to the load time, so the flush closes the last day too
    return stream_breach_alerts(lh.spark, lh.landing_readings(), lh.load_ts, complete_until=lh.load_ts)
