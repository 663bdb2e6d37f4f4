"""The daily batch (the source's ingest -> raw vault -> business vault -> marts chain) as one
Spark application writing tables to shared storage.

Each run takes one batch of raw feeds and:

* stages them (typed views, no data written);
* appends to hubs, links and event satellites only keys not yet present, and to the change-tracked
  satellites only changed versions (``scd_insert``). Reading keys are met with the stored rows of the
  batch's own days, then with a Bloom filter over all keys, and only what passes it with the stored keys
  (``operators/keyset.py``): a key is stored once even if it comes again with another day or with none,
  and the history is not read. Of several rows with one key in a batch the earliest stays;
* derives alerts from the batch's staged readings and inserts new alert keys. Breach windows
  never cross midnight and the landing feed holds one complete file per day, so a batch
  carries whole patient-days; a re-delivered day yields the same deterministic alert ids and
  inserts nothing;
* adds the new readings' value counts to the stored ones of their days and makes the daily statistics of
  the touched (patient, metric, day) groups from them (``operators/daystate.py``; Q4: groups are replaced);
* merges the patient state: first and last day, latest vitals, unacknowledged alerts; and the score state: latest
  scored day, last anomaly day;
* makes the day-grain models (scores, risk, feature mart) anew for the patient-days that changed days or
  demographics touch (``operators/affected.py``) and rewrites only the day partitions that hold them;
* builds the dashboard from the two states and the scored days of the last ``marts.TREND_DAYS`` days.

The row tests declared for a table (not null, accepted values, ranges) are observed while it is written.

The reading satellites are bucketed by reading key within their day partitions, so joins on the key leave
them unshuffled. Small mutable tables are written as new immutable versions (``sinks.write_snapshot``).
A run that fails between two of its writes is not undone: run again with the same feeds it stores no satellite row
twice, but states and day-grain tables that the failed run did not reach would miss its readings. Keep a copy of
the warehouse (or a table format with transactions) to start over from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pulsevault.operators import affected as AF
from pulsevault.operators import alerts as AL
from pulsevault.operators import daystate as DS
from pulsevault.operators import marts as MT
from pulsevault.operators import quality as DQ
from pulsevault.operators import staging as ST
from pulsevault.operators import timeline as TL
from pulsevault.operators import vault as DV
from pulsevault.operators.keyset import KeySet
from pulsevault.plans import data_tests as T
from pulsevault.session import scratch_path
from pulsevault.sources import sinks as SK

#: Event satellites: partitioned by the day of a timestamp column, bucketed by the reading key.
READING_TABLES = {"sat_reading_value": "measured_at", "sat_reading_context": "effective_from"}
#: Day-grain tables, partitioned by ``report_date`` and rewritten by whole days.
DAY_TABLES = ["value_counts", "daily_vitals", "anomaly_score", "risk_profile", "mart_patient_daily_features"]
APPEND_TABLES = ["hub_patient", "hub_reading", "hub_device", "hub_metric_type", "hub_alert",
                 "lnk_patient_device", "lnk_device_metric", "lnk_reading_alert", "sat_alert_detail",
                 "sat_patient_demographics", "sat_device_spec", "data_tests"]


class Warehouse:
    """Table access under one root. ``buckets``: directories of a key set and buckets of a reading satellite
    (a number for the warehouse's whole life; thousands on a cluster)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._results: list[tuple] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keys(self, name: str) -> KeySet:
        return KeySet(self.spark, self.path(f"{name}-keys"), self.buckets)

    def _bucketed(self, name: str) -> SK.BucketedTable:
        return SK.BucketedTable(self.spark, self.path(name), "reading_hk", self.buckets)

    def read(self, name: str, days: list | None = None, since: str | None = None) -> DataFrame | None:
        """The table, or None if it does not exist yet; of a table with days only those of ``days``, if given, or
        those from ``since`` on."""
        if name in READING_TABLES or name in DAY_TABLES:
            df = self._bucketed(name).read() if name in READING_TABLES else SK.read_if_exists(self.spark, self.path(name))
            if df is not None and since is not None:
                df = df.where(F.col("day") >= F.lit(since).cast("date"))
            return None if df is None else SK.read_days(df, days).drop("day")
        if name in APPEND_TABLES:
            return SK.read_if_exists(self.spark, self.path(name))
        if not SK.list_snapshots(self.spark, self.path(name)):
            return None
        return SK.read_snapshot(self.spark, self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        if name in READING_TABLES:
            df = self._bucketed(name).dealt(df.withColumn("day", F.to_date(READING_TABLES[name])))
        with _Observed(self, name, df) as rows:  # above the exchange: an empty one is cut off with what is below
            if name in READING_TABLES:
                self._bucketed(name).append(rows)
            else:
                rows.write.mode("append").parquet(self.path(name))

    def overwrite_days(self, name: str, df: DataFrame) -> None:
        with _Observed(self, name, df) as rows:
            SK.overwrite_days(self.spark, rows.withColumn("day", F.col("report_date")), self.path(name))

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        with _Observed(self, name, df) as rows:
            SK.write_snapshot(self.spark, rows, self.path(name))
        return self.read(name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared scratch folder once and read back."""
        path = scratch_path(self.spark, f"batch-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def report(self, load_ts: str) -> None:
        """Append the failures that this run's writes observed (one row per test) to ``data_tests``."""
        rows, self._results = self._results, []
        if rows:
            report = self.spark.createDataFrame(rows, DQ.REPORT_SCHEMA + ", n_rows bigint")
            report.withColumn("load_datetime", F.lit(load_ts).cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(self.path("data_tests"))


class _Observed:
    """While a table is written, count the rows that fail its declared row tests."""

    def __init__(self, wh: Warehouse, name: str, df: DataFrame):
        self.wh, self.name, self.df = wh, name, df
        self.tests = DQ.row_tests(T.NOT_NULL.get(name, []), T.ACCEPTED.get(name, {}), T.BETWEEN.get(name, {}))
        self.seen = Observation() if self.tests else None

    def __enter__(self) -> DataFrame:
        if self.seen is None:
            return self.df
        counts = [F.count_if(failing).alias(f"t{i}") for i, (_, _, failing) in enumerate(self.tests)]
        return self.df.observe(self.seen, F.count(F.lit(1)).alias("n_rows"), *counts)

    def __exit__(self, error, *_) -> None:
        if error is None and self.seen is not None:
            got = self.seen.get
            self.wh._results += [(self.name, test, column, got[f"t{i}"], got["n_rows"]) for i, (test, column, _) in enumerate(self.tests)]


def _once(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with one key, the earliest."""
    order = [F.col("effective_from").asc_nulls_last(), F.col("hash_diff")]
    return rows.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__k = 1").drop("__k")


def _insert_readings(wh: Warehouse, stg_r: DataFrame, days: list) -> DataFrame:
    """Insert the readings that are new into the hub and both satellites; returns the new value rows. The hub has
    the keys of the value satellite (but for readings without an id), so one key set serves both."""
    new = {}
    for name, build in [("sat_reading_value", DV.sat_reading_value), ("sat_reading_context", DV.sat_reading_context)]:
        rows = wh.keys(name).unseen(_once(build(stg_r), "reading_hk"), "reading_hk", wh.read(name, days))
        new[name] = wh.stored(rows, name)
        if name == "sat_reading_value":
            wh.append("hub_reading", DV.hub_reading(stg_r).join(new[name].select("reading_hk"), "reading_hk", "left_semi"))
        wh.append(name, new[name])
        wh.keys(name).add(new[name].select(F.col("reading_hk").alias("key")))
    return new["sat_reading_value"]


def _insert_alerts(wh: Warehouse, stg_r: DataFrame, days: list, load_ts: str) -> DataFrame:
    """Insert the alerts that are new; returns how many each patient got (patient_hk, active_alerts)."""
    feed = scratch_path(wh.spark, "batch-alerts")
    AL.breach_alerts(stg_r).write.parquet(feed)  # the windows run once, the three tables read the result
    stg_a = ST.stg_alerts(wh.spark.read.parquet(feed), load_ts)
    new = {}
    for name, build in [("hub_alert", DV.hub_alert), ("lnk_reading_alert", DV.lnk_reading_alert), ("sat_alert_detail", DV.sat_alert_detail)]:
        new[name] = wh.stored(build(stg_a, wh.read(name)), name)
        wh.append(name, new[name])
    return MT.active_alert_counts(new["sat_alert_detail"], new["hub_alert"], new["lnk_reading_alert"], wh.read("sat_reading_value", days))


def _refresh_days(wh: Warehouse, changed: DataFrame, demographics: DataFrame, load_ts: str) -> None:
    """Scores, risk, feature mart and score state of the patient-days that changed days and demographics touch."""
    demo = wh.read("sat_patient_demographics")
    if wh.read("anomaly_score") is None:
        units, daily = None, wh.read("daily_vitals")
    else:
        known = lambda days: wh.read("anomaly_score", days).select("patient_hk", "report_date")
        whole = demographics.select("patient_hk").unionByName(changed.where("report_date is null").select("patient_hk")).distinct()
        units = AF.affected_units(changed, whole, wh.read("patient_state"), known)
        days = AF.days_between(units, F.col("start"), F.date_add("until", 1))
        daily = AF.context(wh.read("daily_vitals", [*days, None]), units)
    scored = TL.scored_days(daily)
    scored = wh.stored(scored if units is None else AF.outputs(scored, units), "scored-days")
    risk = TL.risk_days(daily, demo, scored)
    touched = None if units is None else [*AF.days_between(units, F.date_sub("lo", 1), F.col("until")), None]
    for name, rows in [("anomaly_score", TL.anomaly_score(daily, load_ts, scored)), ("risk_profile", TL.risk_profile(daily, demo, load_ts, risk)),
                       ("mart_patient_daily_features", TL.daily_features(daily, demo, risk))]:
        if units is not None and wh.read(name) is not None:
            rows = AF.untouched(wh.read(name, touched), units).select(*rows.columns).unionByName(rows)
        wh.overwrite_days(name, rows)
    old = wh.read("score_state")
    if units is None or old is None:
        wh.replace("score_state", DS.score_state(_scored(wh)))
        return
    fresh = AF.touched(_scored(wh, touched), units)
    state = wh.stored(DS.merged_scores(old, fresh, AF.touched_spans(units)), "score-state")
    settled = state.where("not doubtful").drop("doubtful")
    doubtful = wh.stored(state.where("doubtful").select("patient_hk"), "score-doubtful")
    if not doubtful.isEmpty():
        history = _scored(wh).join(doubtful, "patient_hk", "left_semi")
        settled = settled.unionByName(DS.score_state(history))
    wh.replace("score_state", settled)


def _scored(wh: Warehouse, days: list | None = None, since: str | None = None) -> DataFrame:
    """The scored patient-days with demographics: patient_hk, report_date, composite_anomaly_score, anomaly_flag,
    risk_tier; of some days, or of those from ``since`` on."""
    scores, tiers = (wh.read(name, days, since) for name in ("anomaly_score", "risk_profile"))
    return scores.select("patient_hk", "report_date", "composite_anomaly_score", "anomaly_flag").join(
        tiers.select("patient_hk", "report_date", "risk_tier"), ["patient_hk", "report_date"])


def run_daily_batch(spark: SparkSession, wh: Warehouse, raw_readings: DataFrame, raw_patients: DataFrame,
                    raw_conditions: DataFrame, load_ts: str, as_of: str = MT.DEFAULT_AS_OF) -> None:
    """One daily load. Every step reads the current tables, computes only what is new, and writes."""
    stg_r = ST.stg_readings(raw_readings, load_ts)
    stg_p = ST.stg_patients(raw_patients, load_ts)
    stg_c = ST.stg_conditions(raw_conditions, load_ts)

    # the days of this batch, a handful of dates (None: readings without a time): literal partition filters
    days = [r[0] for r in stg_r.select(F.to_date("measured_at")).distinct().collect()]

    # -- raw vault: keyed inserts ------------------------------------------------------
    for name, build in [("hub_patient", lambda e: DV.hub_patient(stg_p, e)),
                        ("hub_device", lambda e: DV.hub_device(stg_r, e)),
                        ("hub_metric_type", lambda e: DV.hub_metric_type(stg_r, e)),
                        ("lnk_patient_device", lambda e: DV.lnk_patient_device(stg_r, e)),
                        ("lnk_device_metric", lambda e: DV.lnk_device_metric(stg_r, e)),
                        ("sat_device_spec", lambda e: DV.sat_device_spec(stg_r, e))]:
        wh.append(name, build(wh.read(name)))
    demographics = wh.stored(DV.sat_patient_demographics(stg_p, stg_c, wh.read("sat_patient_demographics")), "demographics")
    wh.append("sat_patient_demographics", demographics)
    new = _insert_readings(wh, stg_r, days)
    alerts = _insert_alerts(wh, stg_r, days, load_ts)

    # -- state: value counts per day, patients ------------------------------------------------
    fresh = wh.stored(DS.value_counts(new), "value-counts")
    changed = wh.stored(fresh.select(*DS.GROUP).distinct(), "changed-groups")
    old = wh.read("value_counts", days)
    counts = wh.stored(fresh if old is None else DS.merged_counts(old, fresh), "merged-counts")
    wh.overwrite_days("value_counts", counts)
    states = [s for s in (wh.read("patient_state"), DS.reading_state(new), DS.alert_state(alerts)) if s is not None]
    state = wh.replace("patient_state", DS.merged_state(*states))

    # -- business vault: replace the touched daily groups --------------------------------------
    same = [counts[c].eqNullSafe(changed[c]) for c in DS.GROUP]
    daily = DS.daily_from_counts(counts.join(changed, same, "left_semi"), load_ts)
    old = wh.read("daily_vitals", days)
    if old is not None:
        daily = old.join(changed, [old[c].eqNullSafe(changed[c]) for c in DS.GROUP], "left_anti").unionByName(daily)
    wh.overwrite_days("daily_vitals", daily)

    # -- day-grain models and dashboard ------------------------------------------------------------
    _refresh_days(wh, changed.select("patient_hk", "report_date").distinct(), demographics, load_ts)
    recent = _scored(wh, since=str(dt.date.fromisoformat(as_of) - dt.timedelta(days=MT.TREND_DAYS)))
    wh.replace("mart_anomaly_dashboard", MT.dashboard_rows(
        wh.read("sat_patient_demographics"), wh.read("hub_patient"), MT.summary_from_state(wh.read("score_state"), recent, as_of),
        DS.latest_from_state(state), DS.alerts_from_state(state), as_of))
    wh.report(load_ts)
