"""Domain constants.

FIXED VALUES — these must equal the source system's definitions for results to
match (metric dimension, alert thresholds, SNOMED code sets, device catalogue,
hash-key conventions, expected readings per day, data-quality bounds). They are
listed plainly and in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: surrogate-key convention (md5 over '-'-joined strings, NULL token)
# ---------------------------------------------------------------------------
HASH_SEPARATOR = "-"
HASH_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# ---------------------------------------------------------------------------
# FIXED VALUES: metric dimension
# (code, unit, sample period in seconds, normal low, normal high, description)
# ---------------------------------------------------------------------------
METRICS = [
    ("heart_rate", "bpm", 300, 50.0, 100.0, "Heart rate"),
    ("spo2", "%", 300, 95.0, 100.0, "Blood oxygen saturation (SpO2)"),
    ("steps", "count", 3600, 0.0, 2000.0, "Step count (hourly total)"),
    ("skin_temperature", "°C", 900, 33.0, 37.0, "Skin surface temperature"),
    ("blood_glucose", "mg/dL", 900, 70.0, 140.0, "Interstitial blood glucose (CGM)"),
    ("sleep_stage", "stage", 30, 0.0, 3.0, "Sleep stage (awake/light/deep/rem)"),
]

# FIXED VALUES: expected readings per day used by the completeness percentage
EXPECTED_PER_DAY = {
    "heart_rate": 288,
    "spo2": 288,
    "steps": 24,
    "skin_temperature": 96,
    "blood_glucose": 96,
    "sleep_stage": 480,
}

# FIXED VALUES: clinical alert thresholds (metric, severity, direction, value, description)
THRESHOLDS = [
    ("heart_rate", "critical", "above", 150.0, "Severe tachycardia"),
    ("heart_rate", "critical", "below", 40.0, "Severe bradycardia"),
    ("heart_rate", "warning", "above", 120.0, "Tachycardia"),
    ("heart_rate", "warning", "below", 50.0, "Bradycardia"),
    ("spo2", "critical", "below", 90.0, "Severe hypoxemia"),
    ("spo2", "warning", "below", 93.0, "Hypoxemia"),
    ("blood_glucose", "critical", "below", 70.0, "Hypoglycemia"),
    ("blood_glucose", "warning", "above", 180.0, "Hyperglycemia"),
]

# FIXED VALUES: SNOMED code sets behind the condition flags
SNOMED_DIABETES = ["44054006", "15777000", "368581000119106"]
SNOMED_HYPERTENSION = ["38341003"]
SNOMED_CARDIAC = ["53741008", "413844008", "44784217"]

# FIXED VALUES: device catalogue (model, manufacturer, type, metrics supported)
_WATCH_METRICS = ["heart_rate", "spo2", "steps", "skin_temperature", "sleep_stage"]
DEVICE_MODELS = [
    ("Garmin Venu 3", "Garmin", "smartwatch", _WATCH_METRICS),
    ("Apple Watch Ultra 2", "Apple", "smartwatch", _WATCH_METRICS),
    ("Dexcom G7", "Dexcom", "cgm", ["blood_glucose"]),
    ("Withings ScanWatch 2", "Withings", "smartwatch", _WATCH_METRICS),
]
SMARTWATCH_MODELS = [d for d in DEVICE_MODELS if d[2] == "smartwatch"]
CGM_MODELS = [d for d in DEVICE_MODELS if d[2] == "cgm"]

# FIXED VALUES: serial formats and the firmware placeholder of the device satellite
WATCH_SERIAL_FORMAT = "GRM-W%04d"
CGM_SERIAL_FORMAT = "CGM-%04d"
FIRMWARE_PLACEHOLDER = "1.0.0"

# FIXED VALUES: record sources
SRC_SYNTHEA = "synthea"
SRC_WEARABLE = "wearable_simulator"
SRC_SYSTEM = "system_seed"
SRC_BUSINESS = "business_vault"

# FIXED VALUES: anomaly scoring
ANOMALY_METRICS = ["heart_rate", "spo2", "steps"]
ANOMALY_WEIGHTS = {"heart_rate": 0.4, "spo2": 0.4, "steps": 0.2}
ANOMALY_BASELINE_DAYS = 30
ANOMALY_FLAG_ABOVE = 2.0
ANOMALY_CONTRIB_ABOVE = 1.5
RISK_TIERS = [(1, "low"), (2, "moderate"), (3, "high")]  # else "critical"

# FIXED VALUES: data-quality bounds
HR_PLAUSIBLE = (20, 300)
SPO2_PLAUSIBLE = (70, 100)
DEVICE_STALE_HOURS = 25
SOURCE_FRESHNESS_WARN_HOURS = 26
SOURCE_FRESHNESS_ERROR_HOURS = 50
LANDING_MIN_ROWS = 100
LANDING_REQUIRED_FEEDS = ["readings", "alerts"]
ACCEPTED_GENDER = ["M", "F"]
ACCEPTED_METRICS = [m[0] for m in METRICS]
ACCEPTED_QUALITY = ["good", "noisy", "interpolated"]
ACCEPTED_SEVERITY = ["info", "warning", "critical"]
ACCEPTED_RISK_TIER = ["low", "moderate", "high", "critical"]

# FIXED VALUES: notebook model settings
TRAIN_FRACTION = 0.8
MODEL_SEED = 42
FOREST_TREES = 100
TOPK_TRAINING_ROWS = 10000
EDA_CORR_FEATURES = [
    "hr_mean", "hr_std", "spo2_mean", "spo2_min", "steps_total",
    "skin_temp_mean", "composite_anomaly_score", "anomaly_events_30d",
    "hr_mean_7d_avg", "hr_mean_delta_1d",
]
MODEL_FEATURES = [
    "hr_mean", "hr_std", "hr_min", "hr_max", "spo2_mean", "spo2_min",
    "steps_total", "skin_temp_mean", "composite_anomaly_score",
    "anomaly_events_30d", "hr_mean_7d_avg", "hr_mean_delta_1d",
    "age", "bmi", "condition_count",
    "has_diabetes", "has_hypertension", "has_cardiac_condition",
]
EDA_BOX_FEATURES = ["hr_mean", "spo2_mean", "steps_total"]
