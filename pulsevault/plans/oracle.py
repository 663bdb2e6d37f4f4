"""Reference SQL (DuckDB dialect) for the correctness gate.

Each model is one CTE written straight from the source project's SQL plus the numeric
rules of SURVEY §1.5 (exact half-up decimal averages on integers, one-decimal ratios,
complete-year ages). ``sql(final, *ctes)`` assembles a WITH clause containing the named CTEs
and everything they depend on, in dependency order. This is test-oracle text only; the
engine itself never parses or plans SQL.
"""

from __future__ import annotations

from pulsevault.fixed_values import (
    EXPECTED_PER_DAY, HASH_NULL_TOKEN, METRICS, SNOMED_CARDIAC, SNOMED_DIABETES, SNOMED_HYPERTENSION, THRESHOLDS,
)
from pulsevault.sources.adapters import ACTIVITIES, CONDITION_CODES, EVENT_TO_METRIC, LOCATIONS

LOAD_TS = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF = "DATE '2024-01-31'"


# ---------------------------------------------------------------------------
# SQL helpers
# ---------------------------------------------------------------------------

def key(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{HASH_NULL_TOKEN}')" for c in cols]
    return f"md5(concat_ws('-', {', '.join(parts)}))"


def dec_mean(s: str, n: str, scale: int = 4, precision: int = 10) -> str:
    """Exact half-up mean from an unscaled integer sum and a count."""
    unit = "0." + "0" * (scale - 1) + "1"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DECIMAL(38,0))"
            f" * CAST({unit} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale})) END")


def unscaled(x: str, scale: int = 4) -> str:
    return f"CAST({x} * {10 ** scale} AS BIGINT)"


def avg_dec(x: str, scale: int = 4, precision: int = 10, over: str = "") -> str:
    o = f" OVER {over}" if over else ""
    return dec_mean(f"sum({unscaled(x, scale)}){o}", f"count({x}){o}", scale, precision)


def ratio(num: str, den: str, scale: int, precision: int, scale_out: int) -> str:
    """Half-up num/den at `scale` decimals for non-negative integers."""
    unit = "0." + "0" * (scale - 1) + "1"
    return (f"CAST(CAST((2 * ({num}) * {10 ** scale} + ({den})) // (2 * ({den})) AS DECIMAL(38,0))"
            f" * CAST({unit} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale_out}))")


def age(birth: str, asof: str) -> str:
    return (f"(year({asof}) - year({birth}) - CASE WHEN month({asof}) < month({birth}) OR "
            f"(month({asof}) = month({birth}) AND day({asof}) < day({birth})) THEN 1 ELSE 0 END)")


def case_map(expr: str, pairs, else_: str = "NULL") -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" if isinstance(k, str) else f"WHEN {k} THEN {v!r}" for k, v in pairs)
    return f"CASE {expr} {whens} ELSE {else_} END"


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


EXPECTED_CASE = "CASE metric_code " + " ".join(
    f"WHEN '{m}' THEN {n}" for m, n in EXPECTED_PER_DAY.items()) + " ELSE reading_count END"
SLEEP_UNIT = next(f"'{m[1]}'" if m[1] is not None else "NULL" for m in METRICS if m[0] == "sleep_stage")
UNIT_BY_EVENT = [(e, dict((m[0], m[1]) for m in METRICS)[mc]) for e, mc in EVENT_TO_METRIC]
THRESHOLD_ROWS = ", ".join(f"('{m}', '{s}', '{d}', CAST({v} AS DOUBLE))" for m, s, d, v, _ in THRESHOLDS)


def flags(cc: str) -> str:
    arr = f"string_split({cc}, ',')"
    return (f"list_has_any({arr}, [{in_list(SNOMED_DIABETES)}]) AS has_diabetes, "
            f"list_has_any({arr}, [{in_list(SNOMED_HYPERTENSION)}]) AS has_hypertension, "
            f"list_has_any({arr}, [{in_list(SNOMED_CARDIAC)}]) AS has_cardiac_condition, "
            f"CAST(len(list_filter({arr}, lambda c: c != '')) AS BIGINT) AS condition_count")


# ---------------------------------------------------------------------------
# CTE library: name -> (deps, body)
# ---------------------------------------------------------------------------

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# -- raw feeds (the adapters) -------------------------------------------------
cte("raw_readings", [], f"""
SELECT CAST(event_id AS VARCHAR) AS reading_id,
       CAST(user_id // 10 + 1 AS VARCHAR) AS patient_id,
       CASE WHEN event_type = 'purchase' THEN printf('CGM-%04d', user_id // 10 + 1) ELSE printf('GRM-W%04d', user_id // 10 + 1) END AS device_serial,
       CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'sleep_stage' ELSE {case_map('event_type', EVENT_TO_METRIC)} END AS metric_code,
       CAST(value AS DECIMAL(10,4)) AS value,
       CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN {SLEEP_UNIT} ELSE {case_map('event_type', UNIT_BY_EVENT)} END AS unit,
       CASE WHEN event_id % 50 = 0 THEN 'missing' WHEN event_id % 50 = 1 THEN 'interpolated'
            WHEN event_id % 50 = 2 THEN 'noisy' ELSE 'good' END AS quality_flag,
       CAST(ts AS TIMESTAMP) AS measured_at,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE
         '{{"activity":"' || {case_map('event_id % 3', list(enumerate(ACTIVITIES)))} || '","location_type":"' ||
         {case_map('event_id % 4', list(enumerate(LOCATIONS)))} || '"}}' END AS context
FROM events""")

cte("raw_patients", [], """
SELECT CAST(c.c_custkey AS VARCHAR) AS id,
       CAST(DATE '1940-01-01' + CAST((c.c_custkey * 37) % 24000 AS INTEGER) AS VARCHAR) AS birthdate,
       c.c_name AS first, g.n_name AS last, c.c_mktsegment AS race,
       CASE WHEN c.c_nationkey % 2 = 0 THEN 'nonhispanic' ELSE 'hispanic' END AS ethnicity,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       g.n_name AS city, g.r_name AS state,
       lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS zip,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL WHEN c.c_custkey % 19 = 0 THEN 'unknown'
            ELSE CAST(CAST(18 + (c.c_custkey % 200) / 10.0 AS DECIMAL(5,2)) AS VARCHAR) END AS bmi
FROM customer c
LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n
           LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) g ON c.c_nationkey = g.n_nationkey""")

cte("raw_conditions", [], f"""
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start,
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) END AS stop,
       CAST(o_custkey AS VARCHAR) AS patient,
       CAST(o_orderkey AS VARCHAR) AS encounter,
       {case_map('o_orderkey % 8', [(i, c[0]) for i, c in enumerate(CONDITION_CODES)])} AS code,
       {case_map('o_orderkey % 8', [(i, c[1]) for i, c in enumerate(CONDITION_CODES)])} AS description
FROM orders""")

# -- staging -----------------------------------------------------------------------
cte("stg_readings", ["raw_readings"], f"""
SELECT reading_id, patient_id, device_serial, metric_code, value, unit, quality_flag, measured_at,
       json_extract_string(context, '$.activity') AS activity_type,
       json_extract_string(context, '$.location_type') AS location_type,
       {LOAD_TS} AS load_datetime, 'wearable_simulator' AS record_source
FROM raw_readings
WHERE quality_flag != 'missing' AND reading_id IS NOT NULL AND patient_id IS NOT NULL""")

cte("stg_patients", ["raw_patients"], f"""
SELECT CAST(id AS VARCHAR) AS patient_id, CAST(birthdate AS DATE) AS birth_date, gender, race, ethnicity,
       city, state, zip, TRY_CAST(bmi AS DECIMAL(5,2)) AS bmi, first AS first_name, last AS last_name,
       {LOAD_TS} AS load_datetime, 'synthea' AS record_source
FROM raw_patients WHERE id IS NOT NULL""")

cte("stg_conditions", ["raw_conditions"], f"""
SELECT patient AS patient_id, code AS condition_code, description AS condition_description,
       CAST(start AS DATE) AS onset_date, TRY_CAST(stop AS DATE) AS resolved_date,
       {LOAD_TS} AS load_datetime, 'synthea' AS record_source
FROM raw_conditions WHERE patient IS NOT NULL AND code IS NOT NULL""")

# -- breach windows / alerts ---------------------------------------------------------
cte("thresholds", [], f"SELECT * FROM (VALUES {THRESHOLD_ROWS}) t(metric_code, severity, direction, threshold_value)")

cte("breach_match", ["stg_readings", "thresholds"], """
SELECT r.metric_code, r.patient_id, r.device_serial, r.value, r.measured_at, r.reading_id,
       t.severity, t.direction, t.threshold_value, CAST(r.measured_at AS DATE) AS report_date,
       coalesce(CASE WHEN t.direction = 'above' THEN r.value > CAST(t.threshold_value AS DECIMAL(10,4))
                     ELSE r.value < CAST(t.threshold_value AS DECIMAL(10,4)) END, false) AS is_breach
FROM stg_readings r JOIN thresholds t ON r.metric_code = t.metric_code""")

cte("breach_windows", ["breach_match"], """
SELECT patient_id, metric_code, report_date, severity, direction, any_value(threshold_value) AS threshold_value,
       arg_min(measured_at, (measured_at, reading_id)) AS first_measured_at,
       arg_min(reading_id, (measured_at, reading_id)) AS first_reading_id,
       arg_min(device_serial, (measured_at, reading_id)) AS device_serial,
       arg_min(value, (signed, measured_at, reading_id)) AS worst_value,
       arg_min(reading_id, (signed, measured_at, reading_id)) AS worst_reading_id,
       arg_min(measured_at, (signed, measured_at, reading_id)) AS worst_measured_at,
       count(*) AS n_readings
FROM (SELECT *, CASE WHEN direction = 'above' THEN -value ELSE value END AS signed,
             sum(CASE WHEN is_breach THEN 0 ELSE 1 END) OVER (
                 PARTITION BY patient_id, metric_code, report_date, severity, direction
                 ORDER BY measured_at, reading_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM breach_match) x
WHERE is_breach
GROUP BY patient_id, metric_code, report_date, severity, direction, island""")

cte("raw_alerts", ["breach_windows"], f"""
SELECT {key('patient_id', 'metric_code', 'severity', 'direction', 'first_measured_at')} AS alert_id,
       patient_id, device_serial, 'threshold_breach' AS alert_type, severity, metric_code,
       CAST(threshold_value AS DOUBLE) AS threshold_value,
       CAST(round(worst_value, 2) AS DOUBLE) AS actual_value,
       first_measured_at AS triggered_at, worst_reading_id AS reading_id
FROM breach_windows""")

cte("stg_alerts", ["raw_alerts"], f"""
SELECT alert_id, patient_id, device_serial, alert_type, severity, metric_code,
       CAST(threshold_value AS DECIMAL(10,4)) AS threshold_value, CAST(actual_value AS DECIMAL(10,4)) AS actual_value,
       triggered_at, reading_id, {LOAD_TS} AS load_datetime, 'wearable_simulator' AS record_source
FROM raw_alerts WHERE alert_id IS NOT NULL AND patient_id IS NOT NULL""")

# -- raw vault -------------------------------------------------------------------------


def _hub(name, stage, bk, hk, bk_name, src):
    cte(name, [stage], f"""
SELECT {key(bk)} AS {hk}, {bk} AS {bk_name}, min(load_datetime) AS load_datetime, '{src}' AS record_source
FROM {stage} WHERE {bk} IS NOT NULL GROUP BY {bk}""")


_hub("hub_patient", "stg_patients", "patient_id", "patient_hk", "patient_bk", "synthea")
_hub("hub_reading", "stg_readings", "reading_id", "reading_hk", "reading_id_bk", "wearable_simulator")
_hub("hub_alert", "stg_alerts", "alert_id", "alert_hk", "alert_id_bk", "wearable_simulator")
_hub("hub_device", "stg_readings", "device_serial", "device_hk", "device_serial_bk", "wearable_simulator")
_hub("hub_metric_type", "stg_readings", "metric_code", "metric_type_hk", "metric_code_bk", "system_seed")


def _link(name, stage, keys, link_hk):
    cols = [k for k, _ in keys]
    hks = ", ".join(f"{key(c)} AS {h}" for c, h in keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    cte(name, [stage], f"""
SELECT {key(*cols)} AS {link_hk}, {hks}, min(load_datetime) AS load_datetime, 'wearable_simulator' AS record_source
FROM {stage} WHERE {nn} GROUP BY {', '.join(cols)}""")


_link("lnk_patient_device", "stg_readings", [("patient_id", "patient_hk"), ("device_serial", "device_hk")],
      "patient_device_hk")
_link("lnk_device_metric", "stg_readings", [("device_serial", "device_hk"), ("metric_code", "metric_type_hk")],
      "device_metric_hk")
_link("lnk_reading_alert", "stg_alerts", [("reading_id", "reading_hk"), ("alert_id", "alert_hk")], "reading_alert_hk")

cte("sat_reading_value", ["stg_readings"], f"""
SELECT {key('reading_id')} AS reading_hk, load_datetime,
       {key('metric_code', 'value', 'unit', 'quality_flag')} AS hash_diff,
       measured_at AS effective_from, record_source,
       {key('patient_id')} AS patient_hk, {key('device_serial')} AS device_hk,
       metric_code, value, unit, quality_flag, measured_at
FROM stg_readings""")

cte("sat_reading_context", ["stg_readings"], f"""
SELECT {key('reading_id')} AS reading_hk, load_datetime, {key('activity_type', 'location_type')} AS hash_diff,
       measured_at AS effective_from, record_source, activity_type, location_type, CAST(NULL AS INTEGER) AS mood_score
FROM stg_readings WHERE (activity_type IS NOT NULL OR location_type IS NOT NULL)""")

cte("sat_alert_detail", ["stg_alerts"], f"""
SELECT {key('alert_id')} AS alert_hk, load_datetime,
       {key('alert_type', 'severity', 'metric_code', 'threshold_value', 'actual_value')} AS hash_diff,
       triggered_at AS effective_from, record_source, alert_type, severity, metric_code,
       threshold_value, actual_value, triggered_at, false AS acknowledged, CAST(NULL AS TIMESTAMP) AS acknowledged_at
FROM stg_alerts""")

cte("conditions_agg", ["stg_conditions"], """
SELECT patient_id, array_to_string(list_sort(list(condition_code)), ',') AS chronic_conditions
FROM stg_conditions WHERE resolved_date IS NULL GROUP BY patient_id""")

cte("sat_patient_demographics", ["stg_patients", "conditions_agg"], f"""
SELECT {key('patient_id')} AS patient_hk, load_datetime,
       {key('gender', 'city', 'state', 'zip', 'bmi', 'chronic_conditions')} AS hash_diff,
       load_datetime AS effective_from, record_source, birth_date, gender, race, ethnicity, city, state, zip, bmi,
       chronic_conditions
FROM (SELECT p.*, coalesce(c.chronic_conditions, '') AS chronic_conditions
      FROM stg_patients p LEFT JOIN conditions_agg c ON p.patient_id = c.patient_id) x""")


def device_case(col: str) -> str:
    suffix = f"TRY_CAST(regexp_extract({col}, '\\d+$', 0) AS INTEGER)"
    return f"""CASE WHEN {col} LIKE 'CGM-%' THEN 'Dexcom G7'
            WHEN {col} LIKE 'GRM-W%' AND {suffix} % 3 = 0 THEN 'Garmin Venu 3'
            WHEN {col} LIKE 'GRM-W%' AND {suffix} % 3 = 1 THEN 'Apple Watch Ultra 2'
            WHEN {col} LIKE 'GRM-W%' THEN 'Withings ScanWatch 2' ELSE 'Unknown' END AS device_model,
       CASE WHEN {col} LIKE 'CGM-%' THEN 'Dexcom'
            WHEN {col} LIKE 'GRM-W%' AND {suffix} % 3 = 0 THEN 'Garmin'
            WHEN {col} LIKE 'GRM-W%' AND {suffix} % 3 = 1 THEN 'Apple'
            WHEN {col} LIKE 'GRM-W%' THEN 'Withings' ELSE 'Unknown' END AS manufacturer"""


cte("sat_device_spec", ["stg_readings"], f"""
SELECT {key('device_serial')} AS device_hk, load_datetime,
       {key('device_model', 'manufacturer', 'firmware_version')} AS hash_diff,
       load_datetime AS effective_from, record_source, device_model, manufacturer, firmware_version, battery_level_pct
FROM (SELECT device_serial, load_datetime, 'wearable_simulator' AS record_source, {device_case('device_serial')},
             '1.0.0' AS firmware_version, CAST(NULL AS INTEGER) AS battery_level_pct
      FROM (SELECT device_serial, min(load_datetime) AS load_datetime FROM stg_readings
            WHERE device_serial IS NOT NULL GROUP BY device_serial) d) e""")


def _sampling(p: int) -> str:
    from pulsevault.operators.vault import sampling_label
    return sampling_label(p)


METRIC_DIM_ROWS = ", ".join(
    f"('{m[0]}', '{m[5]}', '{m[1]}', CAST({m[3]} AS DECIMAL(10,4)), CAST({m[4]} AS DECIMAL(10,4)), '{_sampling(m[2])}')"
    for m in METRICS)
cte("sat_metric_definition", ["hub_metric_type"], f"""
SELECT h.metric_type_hk, h.load_datetime,
       {key('d.metric_name', 'd.unit', 'd.lo', 'd.hi', 'd.sampling_frequency')} AS hash_diff,
       h.load_datetime AS effective_from, 'system_seed' AS record_source, d.metric_name, d.unit,
       d.lo AS normal_range_low, d.hi AS normal_range_high, d.sampling_frequency
FROM hub_metric_type h JOIN (VALUES {METRIC_DIM_ROWS}) d(metric_code, metric_name, unit, lo, hi, sampling_frequency)
  ON h.metric_code_bk = d.metric_code""")

# -- business vault ------------------------------------------------------------------------
cte("daily_vitals", ["sat_reading_value"], f"""
SELECT patient_hk, metric_code, report_date, {LOAD_TS} AS load_datetime, 'business_vault' AS record_source,
       reading_count,
       {dec_mean('s', 'n')} AS value_mean,
       CAST(sd AS DECIMAL(10,4)) AS value_std, value_min, value_max,
       CAST(p50 AS DECIMAL(10,4)) AS value_median, CAST(p05 AS DECIMAL(10,4)) AS value_p05,
       CAST(p95 AS DECIMAL(10,4)) AS value_p95,
       {ratio('reading_count * 100', EXPECTED_CASE, 1, 5, 2)} AS completeness_pct
FROM (SELECT patient_hk, metric_code, CAST(measured_at AS DATE) AS report_date, count(*) AS reading_count,
             sum({unscaled('value')}) AS s, count(value) AS n, stddev_samp(value) AS sd,
             min(value) AS value_min, max(value) AS value_max,
             quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.05) AS p05, quantile_disc(value, 0.95) AS p95
      FROM sat_reading_value GROUP BY patient_hk, metric_code, CAST(measured_at AS DATE)) g""")

cte("anomaly_pivot", ["daily_vitals"], """
SELECT patient_hk, report_date,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_mean END) AS hr_mean,
       max(CASE WHEN metric_code = 'spo2' THEN value_mean END) AS spo2_mean,
       max(CASE WHEN metric_code = 'steps' THEN value_mean END) AS steps_mean
FROM daily_vitals WHERE metric_code IN ('heart_rate', 'spo2', 'steps')
GROUP BY patient_hk, report_date""")

# The literal range self-join of the source, deduplicated by grouping (as written there).
cte("baseline_30d", ["anomaly_pivot"], f"""
SELECT c.patient_hk, c.report_date, c.hr_mean, c.spo2_mean, c.steps_mean,
       stddev_samp(CAST(p.hr_mean AS DOUBLE)) AS hr_baseline_std,
       stddev_samp(CAST(p.spo2_mean AS DOUBLE)) AS spo2_baseline_std,
       stddev_samp(CAST(p.steps_mean AS DOUBLE)) AS steps_baseline_std,
       {avg_dec('p.hr_mean')} AS hr_baseline_mean,
       {avg_dec('p.spo2_mean')} AS spo2_baseline_mean,
       {avg_dec('p.steps_mean')} AS steps_baseline_mean
FROM anomaly_pivot c JOIN anomaly_pivot p
  ON p.patient_hk = c.patient_hk AND p.report_date >= c.report_date - 30 AND p.report_date < c.report_date
GROUP BY c.patient_hk, c.report_date, c.hr_mean, c.spo2_mean, c.steps_mean""")


def _guard(p: str, num: str) -> str:
    return (f"CASE WHEN {p}_baseline_std IS NULL OR {p}_baseline_std = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE CAST({num} AS DOUBLE) / {p}_baseline_std END")


cte("zscore", ["baseline_30d"], f"""
SELECT patient_hk, report_date, hr_mean, spo2_mean, steps_mean,
       {_guard('hr', 'abs(hr_mean - hr_baseline_mean)')} AS hr_z,
       {_guard('spo2', 'spo2_baseline_mean - spo2_mean')} AS spo2_z,
       {_guard('steps', 'abs(steps_mean - steps_baseline_mean)')} AS steps_z
FROM baseline_30d""")

cte("anomaly_score", ["zscore"], f"""
SELECT patient_hk, report_date, {LOAD_TS} AS load_datetime, 'business_vault' AS record_source,
       TRY_CAST(hr_z AS DECIMAL(8,4)) AS hr_zscore,
       TRY_CAST(spo2_z AS DECIMAL(8,4)) AS spo2_zscore,
       TRY_CAST(steps_z AS DECIMAL(8,4)) AS steps_zscore,
       TRY_CAST(hr_z * 0.4 + spo2_z * 0.4 + steps_z * 0.2 AS DECIMAL(8,4)) AS composite_anomaly_score,
       (hr_z * 0.4 + spo2_z * 0.4 + steps_z * 0.2) > 2.0 AS anomaly_flag,
       trim(concat_ws(', ', CASE WHEN hr_z > 1.5 THEN 'heart_rate' END, CASE WHEN spo2_z > 1.5 THEN 'spo2' END,
                      CASE WHEN steps_z > 1.5 THEN 'steps' END)) AS contributing_metrics
FROM zscore""")

cte("latest_demographics", ["sat_patient_demographics"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_hk ORDER BY effective_from DESC, hash_diff DESC) AS rn
  FROM sat_patient_demographics) v WHERE rn = 1""")

cte("demo_flags", ["latest_demographics"], f"""
SELECT patient_hk, birth_date, gender, bmi, chronic_conditions, {flags('chronic_conditions')}
FROM latest_demographics""")

cte("rolling_anomaly", ["anomaly_score"], f"""
SELECT patient_hk, report_date, composite_anomaly_score, anomaly_flag,
       {avg_dec('composite_anomaly_score', 4, 8, '(PARTITION BY patient_hk ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS avg_anomaly_score_7d,
       CAST(sum(CAST(anomaly_flag AS INTEGER)) OVER (PARTITION BY patient_hk ORDER BY report_date
            ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS INTEGER) AS anomaly_events_30d
FROM anomaly_score""")

# Literal form of the source: vitals joined to score days within [d-6, d], grouped by the vitals day.
cte("completeness_7d", ["daily_vitals", "anomaly_score"], f"""
SELECT v.patient_hk, v.report_date, {avg_dec('v.completeness_pct', 2, 5)} AS data_completeness_7d
FROM daily_vitals v JOIN anomaly_score a
  ON a.patient_hk = v.patient_hk AND v.report_date >= a.report_date - 6 AND v.report_date <= a.report_date
GROUP BY v.patient_hk, v.report_date""")

cte("risk_profile", ["rolling_anomaly", "demo_flags", "completeness_7d"], f"""
SELECT ra.patient_hk, ra.report_date, {LOAD_TS} AS load_datetime, 'business_vault' AS record_source,
       CAST({age('d.birth_date', 'ra.report_date')} AS BIGINT) AS age,
       d.condition_count, d.has_diabetes, d.has_hypertension, d.has_cardiac_condition,
       CAST(ra.avg_anomaly_score_7d AS DECIMAL(8,4)) AS avg_anomaly_score_7d,
       ra.anomaly_events_30d,
       CAST(c.data_completeness_7d AS DECIMAL(5,2)) AS data_completeness_7d,
       CASE WHEN ra.composite_anomaly_score < 1 THEN 'low' WHEN ra.composite_anomaly_score < 2 THEN 'moderate'
            WHEN ra.composite_anomaly_score < 3 THEN 'high' ELSE 'critical' END AS risk_tier
FROM rolling_anomaly ra JOIN demo_flags d ON d.patient_hk = ra.patient_hk
LEFT JOIN completeness_7d c ON c.patient_hk = ra.patient_hk AND c.report_date = ra.report_date""")

# -- marts ---------------------------------------------------------------------------------------
cte("vitals_wide", ["daily_vitals"], f"""
SELECT patient_hk, report_date,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_mean END) AS hr_mean,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_std END) AS hr_std,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_min END) AS hr_min,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_max END) AS hr_max,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_p05 END) AS hr_p05,
       max(CASE WHEN metric_code = 'heart_rate' THEN value_p95 END) AS hr_p95,
       max(CASE WHEN metric_code = 'spo2' THEN value_mean END) AS spo2_mean,
       max(CASE WHEN metric_code = 'spo2' THEN value_min END) AS spo2_min,
       max(CASE WHEN metric_code = 'steps' THEN reading_count * value_mean END) AS steps_total,
       max(CASE WHEN metric_code = 'skin_temperature' THEN value_mean END) AS skin_temp_mean,
       max(CASE WHEN metric_code = 'blood_glucose' THEN value_mean END) AS glucose_mean,
       max(CASE WHEN metric_code = 'blood_glucose' THEN value_std END) AS glucose_std,
       max(CASE WHEN metric_code = 'sleep_stage' THEN {ratio('reading_count', '60', 1, 10, 1)} END) AS sleep_duration_hrs,
       {avg_dec('completeness_pct', 2, 5)} AS data_completeness
FROM daily_vitals GROUP BY patient_hk, report_date""")

_W = "(PARTITION BY patient_hk ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
cte("rolling_vitals", ["vitals_wide"], f"""
SELECT *,
       {avg_dec('hr_mean', 4, 20, _W)} AS hr_mean_7d_avg,
       {avg_dec('spo2_min', 4, 20, _W)} AS spo2_min_7d_avg,
       {avg_dec('steps_total', 4, 20, _W)} AS steps_total_7d_avg,
       hr_mean - lag(hr_mean) OVER (PARTITION BY patient_hk ORDER BY report_date) AS hr_mean_delta_1d
FROM vitals_wide""")

cte("label_next_day", ["anomaly_score"], """
SELECT patient_hk, report_date - 1 AS report_date, anomaly_flag AS anomaly_next_24h FROM anomaly_score""")

cte("mart_patient_daily_features", ["rolling_vitals", "latest_demographics", "risk_profile", "anomaly_score",
                                    "label_next_day"], """
SELECT rv.patient_hk, rv.report_date, r.age, d.gender, CAST(d.bmi AS DECIMAL(5,2)) AS bmi,
       r.has_diabetes, r.has_hypertension, r.has_cardiac_condition, r.condition_count,
       CAST(rv.hr_mean AS DECIMAL(8,4)) AS hr_mean, CAST(rv.hr_std AS DECIMAL(8,4)) AS hr_std,
       CAST(rv.hr_min AS DECIMAL(8,4)) AS hr_min, CAST(rv.hr_max AS DECIMAL(8,4)) AS hr_max,
       CAST(rv.hr_p05 AS DECIMAL(8,4)) AS hr_p05, CAST(rv.hr_p95 AS DECIMAL(8,4)) AS hr_p95,
       CAST(rv.spo2_mean AS DECIMAL(8,4)) AS spo2_mean, CAST(rv.spo2_min AS DECIMAL(8,4)) AS spo2_min,
       CAST(rv.steps_total AS INTEGER) AS steps_total,
       CAST(rv.skin_temp_mean AS DECIMAL(8,4)) AS skin_temp_mean,
       CAST(rv.glucose_mean AS DECIMAL(8,4)) AS glucose_mean, CAST(rv.glucose_std AS DECIMAL(8,4)) AS glucose_std,
       CAST(rv.sleep_duration_hrs AS DECIMAL(6,2)) AS sleep_duration_hrs,
       CAST(rv.hr_mean_7d_avg AS DECIMAL(8,4)) AS hr_mean_7d_avg,
       CAST(rv.hr_mean_delta_1d AS DECIMAL(8,4)) AS hr_mean_delta_1d,
       CAST(rv.spo2_min_7d_avg AS DECIMAL(8,4)) AS spo2_min_7d_avg,
       CAST(rv.steps_total_7d_avg AS DECIMAL(10,2)) AS steps_total_7d_avg,
       CAST(a.composite_anomaly_score AS DECIMAL(8,4)) AS composite_anomaly_score,
       r.anomaly_events_30d,
       CAST(rv.data_completeness AS DECIMAL(5,2)) AS data_completeness,
       r.risk_tier,
       coalesce(t.anomaly_next_24h, false) AS anomaly_next_24h
FROM rolling_vitals rv
JOIN latest_demographics d ON d.patient_hk = rv.patient_hk
JOIN risk_profile r ON r.patient_hk = rv.patient_hk AND r.report_date = rv.report_date
JOIN anomaly_score a ON a.patient_hk = rv.patient_hk AND a.report_date = rv.report_date
LEFT JOIN label_next_day t ON t.patient_hk = rv.patient_hk AND t.report_date = rv.report_date""")

cte("latest_vital", ["sat_reading_value"], """
SELECT patient_hk,
       arg_max(value, (measured_at, reading_hk)) FILTER (WHERE metric_code = 'heart_rate') AS latest_hr,
       arg_max(value, (measured_at, reading_hk)) FILTER (WHERE metric_code = 'spo2') AS latest_spo2
FROM sat_reading_value WHERE metric_code IN ('heart_rate', 'spo2') GROUP BY patient_hk""")

cte("active_alerts", ["sat_alert_detail", "hub_alert", "lnk_reading_alert", "sat_reading_value"], """
SELECT rv.patient_hk, count(*) AS active_alerts
FROM sat_alert_detail ad JOIN hub_alert ha ON ha.alert_hk = ad.alert_hk
JOIN lnk_reading_alert lra ON lra.alert_hk = ad.alert_hk
JOIN sat_reading_value rv ON rv.reading_hk = lra.reading_hk
WHERE ad.acknowledged = false GROUP BY rv.patient_hk""")

cte("days_since_anomaly", ["anomaly_score"], f"""
SELECT patient_hk, CAST({AS_OF} - max(report_date) AS BIGINT) AS days_since_last_anomaly
FROM anomaly_score WHERE anomaly_flag = true GROUP BY patient_hk""")

cte("anomaly_trend_avgs", ["anomaly_score"], f"""
SELECT patient_hk,
       {avg_dec(f"CASE WHEN report_date >= {AS_OF} - 3 THEN composite_anomaly_score END", 4, 8)} AS recent_avg,
       {avg_dec(f"CASE WHEN report_date >= {AS_OF} - 6 AND report_date < {AS_OF} - 3 THEN composite_anomaly_score END", 4, 8)} AS prior_avg
FROM anomaly_score WHERE report_date >= {AS_OF} - 6 GROUP BY patient_hk""")

cte("anomaly_trend", ["anomaly_trend_avgs"], """
SELECT patient_hk, recent_avg, prior_avg,
       CASE WHEN recent_avg IS NULL OR prior_avg IS NULL THEN 'stable'
            WHEN recent_avg < prior_avg * 0.9 THEN 'improving'
            WHEN recent_avg > prior_avg * 1.1 THEN 'worsening' ELSE 'stable' END AS anomaly_trend
FROM anomaly_trend_avgs""")

cte("mart_anomaly_dashboard", ["sat_patient_demographics", "hub_patient", "risk_profile", "anomaly_score",
                               "latest_vital", "days_since_anomaly", "active_alerts", "anomaly_trend"], f"""
SELECT d.patient_bk, CAST(d.patient_bk AS VARCHAR) AS patient_name, d.age, r.risk_tier,
       CAST(hr.latest_hr AS DECIMAL(8,2)) AS latest_hr, CAST(hr.latest_spo2 AS DECIMAL(8,2)) AS latest_spo2,
       CAST(a.composite_anomaly_score AS DECIMAL(8,4)) AS anomaly_score_today,
       coalesce(t.anomaly_trend, 'stable') AS anomaly_trend,
       ds.days_since_last_anomaly,
       coalesce(aa.active_alerts, 0) AS active_alerts
FROM (SELECT pd.patient_hk, hp.patient_bk, CAST({age('pd.birth_date', AS_OF)} AS BIGINT) AS age
      FROM sat_patient_demographics pd JOIN hub_patient hp ON hp.patient_hk = pd.patient_hk
      WHERE pd.effective_from = (SELECT max(sub.effective_from) FROM sat_patient_demographics sub
                                 WHERE sub.patient_hk = pd.patient_hk)) d
JOIN (SELECT * FROM (SELECT patient_hk, risk_tier, row_number() OVER (PARTITION BY patient_hk ORDER BY report_date DESC) rn
                     FROM risk_profile) x WHERE rn = 1) r ON r.patient_hk = d.patient_hk
JOIN (SELECT * FROM (SELECT patient_hk, composite_anomaly_score,
                            row_number() OVER (PARTITION BY patient_hk ORDER BY report_date DESC) rn
                     FROM anomaly_score) x WHERE rn = 1) a ON a.patient_hk = d.patient_hk
LEFT JOIN latest_vital hr ON hr.patient_hk = d.patient_hk
LEFT JOIN days_since_anomaly ds ON ds.patient_hk = d.patient_hk
LEFT JOIN active_alerts aa ON aa.patient_hk = d.patient_hk
LEFT JOIN anomaly_trend t ON t.patient_hk = d.patient_hk""")


# ---------------------------------------------------------------------------
# Assembly
# ---------------------------------------------------------------------------

def _order(names: list[str]) -> list[str]:
    out: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in CTES[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def sql(final: str, *ctes: str) -> str:
    """WITH <ctes and their dependencies> <final>."""
    names = _order(list(ctes))
    if not names:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in names)
    return f"WITH {body}\n{final}"


def table(name: str, cols: str = "*") -> str:
    """SELECT from one library CTE."""
    return sql(f"SELECT {cols} FROM {name}", name)
