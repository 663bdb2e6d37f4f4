"""The declared data tests of the models: 154 not-null, 17 unique, 15 accepted-values, 11 relationship and 6
range assertions. One table per kind, read by the quality suite and by its oracle."""

from __future__ import annotations

# Model and column names, value lists and bounds of the declared tests.
_GENDER = ["M", "F"]
_METRICS = ["heart_rate", "spo2", "steps", "skin_temperature", "sleep_stage", "blood_glucose"]
_QUALITY = ["good", "noisy", "interpolated"]
_SEVERITY = ["info", "warning", "critical"]
_ALERT_TYPE = ["threshold_breach", "trend_anomaly", "missing_data"]
_ACTIVITY = ["resting", "walking", "running", "driving", "sleeping"]
_TIER = ["low", "moderate", "high", "critical"]
_TREND = ["improving", "stable", "worsening"]

_LOAD = ["load_datetime", "record_source"]
_SAT = ["load_datetime", "hash_diff", "effective_from", "record_source"]

NOT_NULL = {
    "stg_patients": ["patient_id", "birth_date", "gender", "race", "ethnicity", *_LOAD],
    "stg_conditions": ["patient_id", "condition_code", "onset_date", *_LOAD],
    "stg_readings": ["reading_id", "patient_id", "device_serial", "metric_code", "value", "unit", "quality_flag",
                     "measured_at", *_LOAD],
    "stg_alerts": ["alert_id", "patient_id", "device_serial", "alert_type", "severity", "metric_code", "triggered_at",
                   "reading_id", *_LOAD],
    "hub_patient": ["patient_hk", "patient_bk", *_LOAD],
    "hub_device": ["device_hk", "device_serial_bk", *_LOAD],
    "hub_metric_type": ["metric_type_hk", "metric_code_bk", *_LOAD],
    "hub_reading": ["reading_hk", "reading_id_bk", *_LOAD],
    "hub_alert": ["alert_hk", "alert_id_bk", *_LOAD],
    "lnk_patient_device": ["patient_device_hk", "patient_hk", "device_hk", *_LOAD],
    "lnk_device_metric": ["device_metric_hk", "device_hk", "metric_type_hk", *_LOAD],
    "lnk_reading_alert": ["reading_alert_hk", "reading_hk", "alert_hk", *_LOAD],
    "sat_patient_demographics": ["patient_hk", *_SAT, "birth_date", "gender", "race", "ethnicity"],
    "sat_device_spec": ["device_hk", *_SAT, "device_model", "manufacturer", "firmware_version"],
    "sat_reading_value": ["reading_hk", *_SAT, "patient_hk", "device_hk", "metric_code", "value", "unit", "quality_flag",
                          "measured_at"],
    "sat_reading_context": ["reading_hk", *_SAT],
    "sat_alert_detail": ["alert_hk", *_SAT, "alert_type", "severity", "metric_code", "triggered_at", "acknowledged"],
    "daily_vitals": ["patient_hk", "metric_code", "report_date", *_LOAD, "reading_count", "value_mean", "completeness_pct"],
    "anomaly_score": ["patient_hk", "report_date", *_LOAD, "hr_zscore", "spo2_zscore", "steps_zscore",
                      "composite_anomaly_score", "anomaly_flag"],
    "risk_profile": ["patient_hk", "report_date", *_LOAD, "age", "condition_count", "has_diabetes", "has_hypertension",
                     "has_cardiac_condition", "risk_tier"],
    "mart_patient_daily_features": ["patient_hk", "report_date", "age", "gender", "has_diabetes", "has_hypertension",
                                    "has_cardiac_condition", "hr_mean", "spo2_mean", "risk_tier", "anomaly_next_24h"],
    "mart_anomaly_dashboard": ["patient_bk", "age", "risk_tier", "anomaly_trend", "active_alerts"],
}

UNIQUE = [
    ("stg_patients", ["patient_id"]), ("stg_readings", ["reading_id"]), ("stg_alerts", ["alert_id"]),
    ("hub_patient", ["patient_hk"]), ("hub_patient", ["patient_bk"]),
    ("hub_device", ["device_hk"]), ("hub_device", ["device_serial_bk"]),
    ("hub_metric_type", ["metric_type_hk"]), ("hub_metric_type", ["metric_code_bk"]),
    ("hub_reading", ["reading_hk"]), ("hub_reading", ["reading_id_bk"]),
    ("hub_alert", ["alert_hk"]), ("hub_alert", ["alert_id_bk"]),
    ("lnk_patient_device", ["patient_device_hk"]), ("lnk_device_metric", ["device_metric_hk"]),
    ("lnk_reading_alert", ["reading_alert_hk"]), ("mart_anomaly_dashboard", ["patient_bk"]),
]

ACCEPTED = {
    "stg_patients": {"gender": _GENDER},
    "stg_readings": {"metric_code": _METRICS, "quality_flag": _QUALITY},
    "stg_alerts": {"severity": _SEVERITY},
    "hub_metric_type": {"metric_code_bk": _METRICS},
    "sat_patient_demographics": {"gender": _GENDER},
    "sat_reading_value": {"quality_flag": _QUALITY},
    "sat_reading_context": {"activity_type": _ACTIVITY},
    "sat_alert_detail": {"alert_type": _ALERT_TYPE, "severity": _SEVERITY},
    "risk_profile": {"risk_tier": _TIER},
    "mart_patient_daily_features": {"gender": _GENDER, "risk_tier": _TIER},
    "mart_anomaly_dashboard": {"risk_tier": _TIER, "anomaly_trend": _TREND},
}

#: (child, column, parent, parent column)
RELATIONSHIPS = [
    ("lnk_patient_device", "patient_hk", "hub_patient", "patient_hk"),
    ("lnk_patient_device", "device_hk", "hub_device", "device_hk"),
    ("lnk_device_metric", "device_hk", "hub_device", "device_hk"),
    ("lnk_device_metric", "metric_type_hk", "hub_metric_type", "metric_type_hk"),
    ("lnk_reading_alert", "reading_hk", "hub_reading", "reading_hk"),
    ("lnk_reading_alert", "alert_hk", "hub_alert", "alert_hk"),
    ("sat_reading_value", "reading_hk", "hub_reading", "reading_hk"),
    ("sat_reading_context", "reading_hk", "hub_reading", "reading_hk"),
    ("sat_alert_detail", "alert_hk", "hub_alert", "alert_hk"),
    ("sat_patient_demographics", "patient_hk", "hub_patient", "patient_hk"),
    ("sat_device_spec", "device_hk", "hub_device", "device_hk"),
]

BETWEEN = {
    "daily_vitals": {"completeness_pct": (0, 110)},
    "risk_profile": {"age": (0, 130)},
    "mart_patient_daily_features": {"age": (0, 130), "hr_mean": (20, 300), "spo2_mean": (70, 100), "spo2_min": (70, 100)},
}
