"""The layered lakehouse over one data directory, as lazy DataFrames.

``Lakehouse(spark, sf_dir)`` exposes each model of the source project as a method returning a
lazy DataFrame built from the layer below it; nothing runs until an action. Methods are
memoised per object so shared sub-plans are the same logical plan objects, which lets Spark
reuse identical exchanges inside one query. ``materialize`` writes a layer to the shared
checkpoint folder and reads it back, the lineage cut used between layers on large runs.

Layer boundaries: the breach-window alert feed (a window pass over the readings) is written
once to the shared checkpoint folder and read back (``persist_layers``), because the hub, link
and satellite built from it are all consumed by the dashboard and the quality checks; without
the cut each consumer would re-run the window over the readings (different column pruning per
consumer defeats exchange reuse). The day-grain layers need no cut: the fused timeline
(``operators/timeline.py``) consumes the daily statistics exactly once per query.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pulsevault.operators import alerts as AL
from pulsevault.operators import marts as MT
from pulsevault.operators import patients as PT
from pulsevault.operators import business as BV
from pulsevault.operators import staging as ST
from pulsevault.operators import timeline as TL
from pulsevault.operators import vault as DV
from pulsevault.session import scratch_path
from pulsevault.sources.adapters import DriverFeeds


def _memo(fn):
    @functools.wraps(fn)
    def wrapper(self):
        key = fn.__name__
        if key not in self._cache:
            self._cache[key] = fn(self)
        return self._cache[key]
    return wrapper


class Lakehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, load_ts: str = ST.DEFAULT_LOAD_TS,
                 as_of: str = MT.DEFAULT_AS_OF,
                 persist_layers: tuple[str, ...] = ("raw_alerts",)):
        self.spark = spark
        self.sf_dir = sf_dir
        self.load_ts = load_ts
        self.as_of = as_of
        self.persist_layers = set(persist_layers)
        self.feeds = DriverFeeds(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}
        self.scenarios: dict[str, object] = {}  # derived multi-step runs (e.g. incremental batches)

    # -- raw feeds ---------------------------------------------------------
    @_memo
    def raw_readings(self) -> DataFrame:
        return self.feeds.readings()

    @_memo
    def raw_patients(self) -> DataFrame:
        return self.feeds.patients()

    @_memo
    def raw_conditions(self) -> DataFrame:
        return self.feeds.conditions()

    @_memo
    def raw_alerts(self) -> DataFrame:
        """Alert feed derived from the staged readings by the breach-window operator."""
        return self._layer(AL.breach_alerts(self.stg_readings()), "raw_alerts")

    # -- staging -----------------------------------------------------------
    @_memo
    def stg_patients(self) -> DataFrame:
        return ST.stg_patients(self.raw_patients(), self.load_ts)

    @_memo
    def stg_conditions(self) -> DataFrame:
        return ST.stg_conditions(self.raw_conditions(), self.load_ts)

    @_memo
    def stg_readings(self) -> DataFrame:
        return ST.stg_readings(self.raw_readings(), self.load_ts)

    @_memo
    def stg_alerts(self) -> DataFrame:
        return ST.stg_alerts(self.raw_alerts(), self.load_ts)

    # -- raw vault -----------------------------------------------------------
    @_memo
    def hub_patient(self):
        return DV.hub_patient(self.stg_patients())

    @_memo
    def hub_reading(self):
        return DV.hub_reading(self.stg_readings())

    @_memo
    def hub_alert(self):
        return DV.hub_alert(self.stg_alerts())

    @_memo
    def hub_device(self):
        return DV.hub_device(self.stg_readings())

    @_memo
    def hub_metric_type(self):
        return DV.hub_metric_type(self.stg_readings())

    @_memo
    def lnk_patient_device(self):
        return DV.lnk_patient_device(self.stg_readings())

    @_memo
    def lnk_device_metric(self):
        return DV.lnk_device_metric(self.stg_readings())

    @_memo
    def lnk_reading_alert(self):
        return DV.lnk_reading_alert(self.stg_alerts())

    @_memo
    def sat_reading_value(self):
        return DV.sat_reading_value(self.stg_readings())

    @_memo
    def sat_reading_context(self):
        return DV.sat_reading_context(self.stg_readings())

    @_memo
    def sat_alert_detail(self):
        return DV.sat_alert_detail(self.stg_alerts())

    @_memo
    def sat_patient_demographics(self):
        return self._layer(DV.sat_patient_demographics(self.stg_patients(), self.stg_conditions()),
                           "sat_patient_demographics")

    @_memo
    def sat_device_spec(self):
        return DV.sat_device_spec(self.stg_readings())

    @_memo
    def sat_metric_definition(self):
        return DV.sat_metric_definition(self.hub_metric_type())

    # -- business vault ------------------------------------------------------
    @_memo
    def daily_vitals(self):
        # same rows as daily_stats(sat_reading_value): grouped on the business key, hashed per group
        return self._layer(BV.daily_stats(self.stg_readings(), self.load_ts, key="patient_id"), "daily_vitals")

    @_memo
    def scored_days(self):
        """The fused per-patient timeline (scored patient-days), shared by the models below."""
        return TL.scored_days(self.daily_vitals())

    @_memo
    def risk_days(self):
        return TL.risk_days(self.daily_vitals(), self.sat_patient_demographics(), self.scored_days())

    @_memo
    def anomaly_score(self):
        return TL.anomaly_score(self.daily_vitals(), self.load_ts, self.scored_days())

    @_memo
    def risk_profile(self):
        return TL.risk_profile(self.daily_vitals(), self.sat_patient_demographics(), self.load_ts, self.risk_days())

    # -- marts -----------------------------------------------------------------
    @_memo
    def mart_patient_daily_features(self):
        return TL.daily_features(self.daily_vitals(), self.sat_patient_demographics(), self.risk_days())

    @_memo
    def mart_anomaly_dashboard(self):
        return MT.anomaly_dashboard(self.sat_patient_demographics(), self.hub_patient(), self.risk_days(),
                                    self.sat_reading_value(), self.sat_alert_detail(), self.hub_alert(),
                                    self.lnk_reading_alert(), self.as_of)

    # -- simulator-side operators ---------------------------------------------
    @_memo
    def patients_enriched(self):
        return PT.enrich_patients(self.stg_patients(), self.stg_conditions())

    @_memo
    def breach_windows(self):
        return AL.breach_windows(self.stg_readings())

    # -- landing files written from the feeds (shared by the file-source checks) -----
    def landing_readings(self) -> str:
        """Raw readings as a day-partitioned NDJSON landing tree (written once per object)."""
        if "landing_readings" not in self._paths:
            from pulsevault.sources.sinks import write_ndjson_by_day
            path = scratch_path(self.spark, "landing-readings")
            write_ndjson_by_day(self.raw_readings(), path, "measured_at", json_cols=["context"])
            self._paths["landing_readings"] = path
        return self._paths["landing_readings"]

    def landing_alerts(self) -> str:
        if "landing_alerts" not in self._paths:
            from pulsevault.sources.sinks import write_ndjson_by_day
            path = scratch_path(self.spark, "landing-alerts")
            write_ndjson_by_day(self.raw_alerts(), path, "triggered_at")
            self._paths["landing_alerts"] = path
        return self._paths["landing_alerts"]

    # -- materialisation -------------------------------------------------------
    def _layer(self, df: DataFrame, name: str) -> DataFrame:
        return self.materialize(df, name) if name in self.persist_layers else df

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write to the shared checkpoint folder and read back (cuts lineage; survives executor loss)."""
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


_REGISTRY: dict[tuple[str, int, str], Lakehouse] = {}


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Shared Lakehouse per (session, directory) so queries reuse plan objects."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _REGISTRY:
        _REGISTRY[key] = Lakehouse(spark, sf_dir)
    return _REGISTRY[key]


def reset() -> None:
    """Forget shared Lakehouse objects (their persisted layers are rebuilt on next use)."""
    _REGISTRY.clear()
