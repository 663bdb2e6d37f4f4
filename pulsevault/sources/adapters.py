"""Adapters: the driver's generic tables -> the raw health feeds this engine consumes.

The generic tables (events, customer, nation, region, orders) stand in for the wearable
landing zone and the Synthea CSV exports. Every mapping is a pure projection or a
small-dimension join, so it stays one narrow stage at any scale. The same mapping is
written a second time in DuckDB SQL (``pulsevault.plans.oracle``) for the correctness gate.

Raw feeds carry the *landing* column names (lower-cased, as the file readers normalise them):

* readings:   reading_id, patient_id, device_serial, metric_code, value, unit, quality_flag,
              measured_at, context
* patients:   id, birthdate, first, last, race, ethnicity, gender, city, state, zip, bmi
* conditions: start, stop, patient, encounter, code, description
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsevault.fixed_values import CGM_SERIAL_FORMAT, METRICS, WATCH_SERIAL_FORMAT

# Adapter mapping choices (ours, mirrored in the oracle SQL).
EVENT_TO_METRIC = [
    ("view", "heart_rate"),
    ("click", "spo2"),
    ("error", "steps"),
    ("signup", "skin_temperature"),
    ("purchase", "blood_glucose"),
]
SLEEP_EVENT = "error"                                   # odd ids of this type are sleep stages
USERS_PER_PATIENT = 10                                  # so that a patient-day holds several readings per metric
ACTIVITIES = ["walking", "resting", "running"]          # by event_id % 3
LOCATIONS = ["home", "outdoor", "gym", "office"]        # by event_id % 4
CONDITION_CODES = [                                     # by o_orderkey % 8
    ("44054006", "Diabetes mellitus type 2"),
    ("15777000", "Prediabetes"),
    ("368581000119106", "Prediabetes (alternate)"),
    ("38341003", "Hypertensive disorder"),
    ("53741008", "Coronary artery disease"),
    ("413844008", "Chronic ischemic heart disease"),
    ("49436004", "Atrial fibrillation"),
    ("44784217", "Cardiac arrhythmia"),
]
BIRTH_EPOCH = "1940-01-01"


_TABLES: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy scan. The handle (schema and file listing, like a catalog entry)
    is kept per session and path; every query still scans the files."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _case(col: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v)))
    return expr if default is None else expr.otherwise(default)


def readings_from_events(events: DataFrame) -> DataFrame:
    """events -> raw reading feed (typed measured_at; files carry it as ISO text)."""
    eid = F.col("event_id")
    metric = _case(F.col("event_type"), EVENT_TO_METRIC)
    metric = F.when((F.col("event_type") == SLEEP_EVENT) & (eid % 2 == 1), "sleep_stage").otherwise(metric)
    unit = _case(metric, [(m[0], m[1]) for m in METRICS])
    patient = (F.floor(F.col("user_id") / USERS_PER_PATIENT) + 1).cast("long")
    device = F.when(F.col("event_type") == "purchase", F.format_string(CGM_SERIAL_FORMAT, patient)) \
        .otherwise(F.format_string(WATCH_SERIAL_FORMAT, patient))
    quality = F.when(eid % 50 == 0, "missing").when(eid % 50 == 1, "interpolated") \
        .when(eid % 50 == 2, "noisy").otherwise("good")
    activity = _case(eid % 3, list(enumerate(ACTIVITIES)))
    location = _case(eid % 4, list(enumerate(LOCATIONS)))
    context = F.when(eid % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('{"activity":"'), activity, F.lit('","location_type":"'), location, F.lit('"}')))
    return events.select(
        eid.cast("string").alias("reading_id"),
        patient.cast("string").alias("patient_id"),
        device.alias("device_serial"),
        metric.alias("metric_code"),
        F.col("value").cast("decimal(10,4)").alias("value"),
        unit.alias("unit"),
        quality.alias("quality_flag"),
        F.col("ts").alias("measured_at"),
        context.alias("context"),
    )


def patients_from_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customer ⟕ nation ⟕ region -> raw patients CSV rows (all strings).

    nation and region are fixed 25- and 5-row dimensions: broadcasting them is size-safe.
    """
    k = F.col("c_custkey")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left") \
        .select("n_nationkey", "n_name", "r_name")
    bmi = F.when(k % 17 == 0, F.lit(None).cast("string")) \
        .when(k % 19 == 0, F.lit("unknown")) \
        .otherwise((F.lit(18) + (k % 200).cast("decimal(10,0)") / F.lit(10)).cast("decimal(5,2)").cast("string"))
    return customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey, "left").select(
        k.cast("string").alias("id"),
        F.date_add(F.lit(BIRTH_EPOCH).cast("date"), ((k * 37) % 24000).cast("int")).cast("string").alias("birthdate"),
        F.col("c_name").alias("first"),
        F.col("n_name").alias("last"),
        F.col("c_mktsegment").alias("race"),
        F.when(F.col("c_nationkey") % 2 == 0, "nonhispanic").otherwise("hispanic").alias("ethnicity"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip"),
        bmi.alias("bmi"),
    )


def conditions_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> raw conditions CSV rows (all strings); 'F' orders become resolved after 30 days."""
    code = _case(F.col("o_orderkey") % 8, [(i, c[0]) for i, c in enumerate(CONDITION_CODES)])
    desc = _case(F.col("o_orderkey") % 8, [(i, c[1]) for i, c in enumerate(CONDITION_CODES)])
    start = F.to_date(F.col("o_orderdate"))
    return orders.select(
        start.cast("string").alias("start"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(start, 30).cast("string")).alias("stop"),
        F.col("o_custkey").cast("string").alias("patient"),
        F.col("o_orderkey").cast("string").alias("encounter"),
        code.alias("code"),
        desc.alias("description"),
    )


class DriverFeeds:
    """Raw feeds over one driver data directory (lazy DataFrames, built once per object)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def readings(self) -> DataFrame:
        return readings_from_events(self.table("events"))

    def patients(self) -> DataFrame:
        return patients_from_customers(self.table("customer"), self.table("nation"), self.table("region"))

    def conditions(self) -> DataFrame:
        return conditions_from_orders(self.table("orders"))
