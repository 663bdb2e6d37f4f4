"""Streaming breach alerts: two chained queries, readings to run fragments and fragments to alerts.

``finished_buckets`` gathers the readings of every (patient, metric, day, time bucket); when the watermark passes the
bucket's end they leave its state and become fragments (``operators.alerts.run_fragments``): runs of breaching readings
and a marker with the number of the others. A flooding device is thus dealt over 24 keys a day (more with a smaller
bucket), and a key's state is at most one bucket's readings. The fragments go to a file table, and with them the time
up to which that table is complete. ``finished_days`` reads that table as a stream and gathers the fragments of a day;
when the day is over they are stitched (``operators.alerts.stitched``), so a run across a bucket's border is one alert.
State, windows and aggregates are Spark's own: no key costs a call of Python. The state lies on disk
(``session.STATE_CONF``). The result is independent of how readings were split over micro-batches or ordered inside
files, and equal to the batch operator for every completed day.

A day whose end is still ahead of the watermark has not finished and emits nothing yet. Where the
feed is known to be complete up to some time, ``stream_breach_alerts`` ends its run with a tick of a
second input, the clock, which moves the watermark past that time and so closes the last days.
Rows of buckets that the watermark (two hours by default) has passed are dropped, unlike in batch, and so are
readings without a time, which belong to no day. A missing value breaches nothing, as in batch.

``evaluate_day`` states the same in one process, as a reference for tests: a patient-day is a sequence of elements for
every threshold, runs and separators (non-breaching readings, of which only the places count), and once no reading can
come between them any more it is *folded* (``folded``): neighbouring runs are one run, neighbouring separators one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pulsevault.fixed_values import THRESHOLDS
from pulsevault.functions import event_time
from pulsevault.operators.alerts import alert_feed, run_fragments, stitched
from pulsevault.operators.staging import stg_readings
from pulsevault.session import scratch_path, state_on_disk
from pulsevault.streaming.readings import readings_stream

_KEY = ["patient_id", "metric_code", "report_date"]
_READING = ["measured_at", "reading_id", "device_serial", "value"]
#: An element: threshold number (-1: a waiting reading, with its value as the worst one), first reading, worst reading,
#: readings in the run (0: a separator), last time.
_COLUMNS = ["k", "first_us", "first_id", "device_serial", "worst", "worst_id", "worst_us", "n", "last_us"]
_ABOVE = np.array([direction == "above" for _, _, direction, _, _ in THRESHOLDS])
#: Later than any time: everything is settled.
_EVER = np.iinfo(np.int64).max


def waiting(ts, ids, vals, devs) -> pd.DataFrame:
    """Readings in any order as elements that wait."""
    ts = np.asarray(ts, dtype="int64")
    return pd.DataFrame({"k": -1, "first_us": ts, "first_id": list(ids), "device_serial": list(devs), "worst": np.asarray(vals, dtype="float64"),
                         "worst_id": list(ids), "worst_us": ts, "n": 1, "last_us": ts})


def elements(metric_code: str, readings: pd.DataFrame) -> pd.DataFrame:
    """One element per waiting reading and threshold of the metric."""
    parts = []
    for k, (metric, _, direction, limit, _) in enumerate(THRESHOLDS):
        if metric == metric_code:
            breach = (readings["worst"] > limit) if direction == "above" else (readings["worst"] < limit)
            parts.append(readings.assign(k=k, n=breach.astype("int64")))
    return pd.concat(parts, ignore_index=True) if parts else _no_elements()


def _no_elements() -> pd.DataFrame:
    return pd.DataFrame({c: [] for c in _COLUMNS})


def folded(metric_code: str, e: pd.DataFrame, settled_us: int) -> pd.DataFrame:
    """The shortest sequence of elements that stands for ``e``, when no reading before ``settled_us`` can come any more."""
    ready = (e["k"] < 0) & (e["last_us"] < settled_us)
    still = e[(e["k"] < 0) & ~ready]
    e = pd.concat([e[e["k"] >= 0], elements(metric_code, e[ready])], ignore_index=True) if ready.any() else e[e["k"] >= 0]
    if e.empty:
        return still.reset_index(drop=True)
    e = e.sort_values(["k", "first_us", "first_id"], kind="mergesort", na_position="first", ignore_index=True)
    k, run, settled = e["k"].to_numpy(), e["n"].to_numpy() > 0, e["last_us"].to_numpy() < settled_us
    starts = np.r_[True, (k[1:] != k[:-1]) | (run[1:] != run[:-1])]
    separators = e[~run & (starts | ~settled)]
    fragment = np.cumsum(starts | ~settled | ~np.r_[False, settled[:-1]])
    runs = e[run].assign(fragment=fragment[run])
    first = runs.drop_duplicates("fragment")
    signed = np.where(_ABOVE[runs["k"].to_numpy().astype(int)], -runs["worst"], runs["worst"])
    worst = runs.assign(signed=signed).sort_values(["fragment", "signed", "worst_us", "worst_id"], kind="mergesort", na_position="first") \
        .drop_duplicates("fragment")
    merged = first.assign(worst=worst["worst"].to_numpy(), worst_id=worst["worst_id"].to_numpy(), worst_us=worst["worst_us"].to_numpy(),
                          n=runs.groupby("fragment", sort=False)["n"].sum().to_numpy(),
                          last_us=runs.drop_duplicates("fragment", keep="last")["last_us"].to_numpy())
    e = pd.concat([separators, merged[_COLUMNS]]).sort_index()
    return pd.concat([e, still], ignore_index=True) if len(still) else e.reset_index(drop=True)


def evaluate_day(key: tuple, ts, ids, vals, devs) -> pd.DataFrame:
    """Breach windows of one patient-day of one metric (readings in any order)."""
    patient_id, metric_code, report_date = key
    e = folded(metric_code, waiting(ts, ids, vals, devs), _EVER)
    e = e[e["n"] > 0]
    named = pd.DataFrame([THRESHOLDS[int(k)][1:4] for k in e["k"]], columns=["severity", "direction", "threshold_value"], index=e.index)
    out = pd.concat([named, e.rename(columns={"first_id": "first_reading_id", "worst": "worst_value", "worst_id": "worst_reading_id",
                                              "n": "n_readings"}).drop(columns=["k", "last_us"])], axis=1)
    out.insert(0, "patient_id", patient_id)
    out.insert(1, "metric_code", metric_code)
    out.insert(2, "report_date", report_date)
    return out.reset_index(drop=True)


def _bucket(bucket_seconds: int) -> int:
    """The longest bucket up to ``bucket_seconds`` that divides a day, so that none goes over midnight."""
    return next(s for s in range(min(bucket_seconds, 86_400), 0, -1) if 86_400 % s == 0)


def _ticks(clock: DataFrame) -> DataFrame:
    """Rows without an item at the times of a clock (column ``at``, ISO text): they only move the watermark. Their names
    are empty but no constants: from a batch of ticks alone Spark would infer that what leaves the state has them too."""
    at, empty = F.col("at").cast("timestamp_ntz"), F.substring("at", 1, 0)
    return clock.select(empty.alias("patient_id"), empty.alias("metric_code"), F.to_date(at).alias("report_date"), event_time(at).alias("event_time"))


def _collected(rows: DataFrame, clock: DataFrame | None, watermark: str, span: str) -> DataFrame:
    """(patient_id, metric_code, report_date, items): the ``item`` of all rows of a span that is over."""
    if clock is not None:
        rows = rows.unionByName(_ticks(clock), allowMissingColumns=True)
    return rows.withWatermark("event_time", watermark).groupBy(F.window("event_time", span), "patient_id", "metric_code", "report_date") \
        .agg(F.collect_list("item").alias("items")).drop("window")


def finished_buckets(staged: DataFrame, watermark: str = "2 hours", clock: DataFrame | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Staged reading stream -> the readings of every (patient, metric, day, bucket) that is over."""
    metrics = sorted({m for m, *_ in THRESHOLDS})
    s = staged.where(F.col("metric_code").isin(metrics) & F.col("measured_at").isNotNull()).select(
        "patient_id", "metric_code", F.to_date("measured_at").alias("report_date"), event_time("measured_at").alias("event_time"),
        F.struct(*_READING).alias("item"))
    return _collected(s, clock, watermark, f"{_bucket(bucket_seconds)} seconds")


def finished_days(fragments: DataFrame, clock: DataFrame | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Fragment stream -> the fragments of every (patient, metric, day) that is over. Fragments leave their buckets in
    the order of the buckets' ends, so no delay is needed."""
    start = F.timestamp_seconds(F.unix_date("report_date").cast("long") * 86_400 + F.col("__b") * _bucket(bucket_seconds))
    names = [c for c in fragments.columns if c not in _KEY]
    return _collected(fragments.select(*_KEY, start.alias("event_time"), F.struct(*names).alias("item")), clock, "0 seconds", "1 day")


def _run(rows: DataFrame, path: str, checkpoint: str, made: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Work off what is available: what ``made`` makes of the items that are over goes to the Parquet table at ``path``,
    a directory per micro-batch, so that one that runs again replaces its rows."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        items = batch.select(*_KEY, F.inline("items"))
        made(items).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    with state_on_disk(rows.sparkSession):
        query = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _watermark(query: StreamingQuery) -> dt.datetime | None:
    """The watermark of the query's last batch that had one (UTC wall clock)."""
    seen = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    return dt.datetime.fromisoformat(seen[-1].replace("Z", "")) if seen else None


def stream_breach_alerts(spark: SparkSession, landing_root: str, load_ts: str, max_files_per_trigger: int | None = None,
                         complete_until: str | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Run both queries over all available landing files; returns the emitted alerts. With
    ``complete_until`` the run ends by closing every day that is over at that time."""
    place = {name: scratch_path(spark, f"stream-{name}") for name in ("clock", "fragments", "progress", "alerts", "ckpt-1", "ckpt-2")}

    def tick(name: str, at: dt.datetime) -> None:
        spark.createDataFrame([(at.isoformat(),)], "at string").coalesce(1).write.mode("append").json(place[name])

    def clock(name: str) -> DataFrame:
        tick(name, dt.datetime(1970, 1, 2))
        return spark.readStream.schema("at string").json(place[name])

    staged = stg_readings(readings_stream(spark, landing_root, max_files_per_trigger), load_ts)
    buckets = finished_buckets(staged, clock=clock("clock"), bucket_seconds=bucket_seconds)

    def fragments(readings: DataFrame) -> DataFrame:
        return run_fragments(readings, bucket_seconds=_bucket(bucket_seconds))

    def read_on() -> None:
        """Let the first query read on, and tell the second up to where its table is complete."""
        watermark = _watermark(_run(buckets, place["fragments"], place["ckpt-1"], fragments))
        if watermark is not None and watermark > dt.datetime(1970, 1, 2):
            tick("progress", watermark - dt.timedelta(milliseconds=1))  # a day that ends at the watermark itself waits

    progress = clock("progress")
    read_on()
    if complete_until is not None:
        # beyond the watermark's delay, so that the watermark itself passes the given time
        tick("clock", dt.datetime.fromisoformat(complete_until) + dt.timedelta(days=1))
        read_on()
    schema = spark.read.parquet(place["fragments"]).drop("batch").schema
    stored = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(place["fragments"])
    _run(finished_days(stored, progress, bucket_seconds), place["alerts"], place["ckpt-2"], lambda f: alert_feed(stitched(f)))
    return spark.read.parquet(place["alerts"]).drop("batch")
