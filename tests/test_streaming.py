"""Streaming slice: the per-key state helper on the golden fixture; stream == batch on completed days."""

import datetime as dt
import json
import os
import pathlib
import random

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from pulsevault.fixed_values import THRESHOLDS
from pulsevault.streaming.alerts import evaluate_day, folded, waiting


def test_state_helper_golden_breach_windows():
    base = int(dt.datetime(2024, 1, 1, 10, 0).timestamp() * 1e6)
    values = [100, 125, 155, 160, 130, 120, 45, 38]
    ts = [base + i * 300_000_000 for i in range(len(values))]
    ids = [f"r{i}" for i in range(len(values))]
    # shuffled input order must not matter
    order = [3, 0, 7, 5, 1, 6, 2, 4]
    got = evaluate_day(("p1", "heart_rate", dt.date(2024, 1, 1)), [ts[i] for i in order], [ids[i] for i in order],
                       [float(values[i]) for i in order], ["d"] * 8)
    rows = {(r.severity, r.direction): r for r in got.itertuples()}
    assert rows[("critical", "above")].first_reading_id == "r2" and rows[("critical", "above")].worst_reading_id == "r3"
    assert rows[("warning", "above")].first_reading_id == "r1" and rows[("warning", "above")].n_readings == 4
    assert rows[("critical", "below")].first_reading_id == "r7"
    assert rows[("warning", "below")].first_reading_id == "r6" and rows[("warning", "below")].worst_value == 38.0


def runs_by_definition(metric, rows):
    """(threshold, first time, first id, device, worst value, worst id, readings) of every run of breaching readings."""
    out = []
    for k, (m, _, direction, limit, _) in enumerate(THRESHOLDS):
        if m != metric:
            continue
        run = []
        for row in [*sorted(rows), None]:
            if row is not None and row[2] is not None and (row[2] > limit if direction == "above" else row[2] < limit):
                run.append(row)
                continue
            if run:
                worst = min(run, key=lambda r: (-r[2] if direction == "above" else r[2], r[0], r[1]))
                out.append((k, run[0][0], run[0][1], run[0][3], worst[2], worst[1], len(run)))
            run = []
    return out


def test_folding_as_readings_arrive_equals_the_whole_day():
    """Readings arrive in any order behind a watermark; the stored sequence is folded after each."""
    rng = random.Random(7)
    for trial in range(60):
        rows = [(rng.randrange(40) * 10, f"r{i:03d}", rng.choice([None, 30.0, 45.0, 60.0, 80.0, 125.0, 130.0, 160.0, 170.0]), f"d{i % 3}")
                for i in range(rng.randint(1, 60))]
        arriving = sorted(rows, key=lambda r: r[0] + rng.randrange(100))  # late by less than 100
        stored = None
        while arriving:
            part, arriving = arriving[:5], arriving[5:]
            new = waiting([r[0] for r in part], [r[1] for r in part], [r[2] for r in part], [r[3] for r in part])
            settled = min([r[0] for r in arriving], default=10 ** 9) if trial % 2 else 0
            stored = folded("heart_rate", new if stored is None else pd.concat([stored, new], ignore_index=True), settled)
            assert folded("heart_rate", stored, settled).equals(stored)
        if trial % 2:
            got = stored[stored["n"] > 0]
        else:
            final = folded("heart_rate", stored, 10 ** 9)
            got = final[final["n"] > 0]
        names = ["k", "first_us", "first_id", "device_serial", "worst", "worst_id", "n"]
        assert [tuple(r) for r in got[names].itertuples(index=False)] == runs_by_definition("heart_rate", rows)


def test_the_state_is_bounded_by_runs_not_readings():
    """Behind the watermark a sequence of any length is its runs and one separator between two of them."""
    for value, n in [(97.0, 0), (85.0, 5000)]:
        e = waiting(range(5000), [f"r{i}" for i in range(5000)], [value] * 5000, ["d"] * 5000)
        assert len(folded("spo2", e, 0)) == 5000  # a reading waits once, not once per threshold
        part = folded("spo2", e, 4000)
        assert part[part["k"] >= 0]["n"].tolist() == [min(n, 4000)] * 2 and (part["k"] < 0).sum() == 1000
        assert folded("spo2", part, 10 ** 9)["n"].tolist() == [n] * 2
    assert folded("spo2", e.iloc[:0], 5).empty


def landed(folder, files):
    """One NDJSON file per micro-batch, in the order of their times."""
    for k, rows in enumerate(files):
        path = folder / f"f{k}.json"
        path.write_text("".join(json.dumps({
            "reading_id": f"{k}-{i}", "patient_id": "p", "device_serial": "GRM-W0001", "metric_code": "heart_rate", "value": value,
            "unit": "bpm", "quality_flag": "good", "measured_at": at, "context": None}) + "\n" for i, (at, value) in enumerate(rows)))
        os.utime(path, (1_700_000_000 + 100 * k,) * 2)


def test_runs_across_buckets_and_rows_of_a_bucket_that_closes_as_they_come(spark, tmp_path):
    """The third file is on time for the watermark it is filtered by, but its buckets are over for the one it is worked
    with; a run goes on over the borders of three buckets, and its middle arrives last."""
    from pulsevault.streaming.alerts import stream_breach_alerts
    landed(tmp_path, [
        [("2024-01-10T10:14:00", 160.0), ("2024-01-10T10:31:00", 170.0), ("2024-01-10T10:32:00", 70.0), ("2024-01-10T10:33:00", 155.0),
         ("2024-01-10T12:00:00", 70.0)],
        [("2024-01-11T05:00:00", 60.0), (None, 200.0)],
        [("2024-01-10T20:00:00", 180.0), ("2024-01-10T10:20:00", 165.0)],
    ])
    got = stream_breach_alerts(spark, f"file://{tmp_path}", "2024-01-31 00:00:00", max_files_per_trigger=1,
                               complete_until="2024-01-12 00:00:00", bucket_seconds=900)
    rows = sorted((str(r.triggered_at), r.severity, r.actual_value, r.reading_id) for r in got.collect())
    assert rows == [(f"2024-01-10 {at}", severity, value, i) for at, value, i in
                    [("10:14:00", 170.0, "0-1"), ("10:33:00", 155.0, "0-3"), ("20:00:00", 180.0, "2-0")] for severity in ("critical", "warning")]


def test_stream_equals_batch_on_all_days(spark):
    qs = E.queries()
    stream = qs["stream_breach_alerts"](spark, SF_SMALL)
    batch = qs["breach_alerts"](spark, SF_SMALL).select(*stream.columns)
    last = qs["stg_readings"](spark, SF_SMALL).agg(F.max(F.to_date("measured_at"))).first()[0]
    assert batch.where(F.to_date("triggered_at") == F.lit(last)).count() > 0
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def test_without_the_flush_the_last_day_stays_open(spark):
    from pulsevault.plans.lakehouse import lakehouse
    from pulsevault.streaming.alerts import stream_breach_alerts
    lh = lakehouse(spark, SF_SMALL)
    got = stream_breach_alerts(spark, lh.landing_readings(), lh.load_ts)
    last = lh.stg_readings().agg(F.max(F.to_date("measured_at"))).first()[0]
    done = lh.raw_alerts().where(F.to_date("triggered_at") < F.lit(last)).select(*got.columns)
    assert got.count() == done.count() and got.exceptAll(done).count() == 0


def test_rows_later_than_the_default_watermark_are_dropped(spark, tmp_path):
    """One file per micro-batch, in the order of their times: a day that arrives after its successors is late."""
    from pulsevault.streaming.readings import stream_daily_stats
    for k, (day, n) in enumerate([("2024-01-10", 3), ("2024-01-11", 2), ("2024-01-01", 4), ("2024-01-11", 1)]):
        path = tmp_path / f"f{k}.json"
        path.write_text("".join(json.dumps({
            "reading_id": f"{k}-{i}", "patient_id": "p", "device_serial": "GRM-W0001", "metric_code": "heart_rate", "value": 60.0 + i,
            "unit": "bpm", "quality_flag": "good", "measured_at": f"{day}T{10 + i}:00:00", "context": None}) + "\n" for i in range(n)))
        os.utime(path, (1_700_000_000 + 100 * k,) * 2)
    got = stream_daily_stats(spark, f"file://{tmp_path}", "2024-01-31 00:00:00", max_files_per_trigger=1)
    assert {str(r.report_date): r.reading_count for r in got.collect()} == {"2024-01-10": 3, "2024-01-11": 3}


def providers(checkpoint):
    """The state store that the query's micro-batches used."""
    return {json.loads(line)["conf"]["spark.sql.streaming.stateStore.providerClass"].rsplit(".", 1)[1]
            for f in (checkpoint / "offsets").iterdir() if f.name.isdigit() for line in f.read_text().splitlines()[1:2]}


def test_alerts_cost_no_python_call_a_key_and_no_heap_a_key(spark, tmp_path, monkeypatch):
    """state, windows and aggregates of both queries are Spark's own, their state lies on disk; ticks alone close a day."""
    from pulsevault.streaming import alerts
    ran, run = [], alerts._run

    def seen(rows, path, checkpoint, *made):
        ran.append((run(rows, path, checkpoint, *made), pathlib.Path(checkpoint.removeprefix("file:"))))
        return ran[-1][0]
    monkeypatch.setattr(alerts, "_run", seen)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    landing = tmp_path / "landing"
    landing.mkdir()
    landed(landing, [[("2024-01-10T10:14:00", 170.0), ("2024-01-10T10:31:00", 70.0), ("2024-01-10T11:05:00", 165.0), ("2024-01-10T12:05:00", 180.0)]])
    got = alerts.stream_breach_alerts(spark, f"file://{landing}", "2024-01-31 00:00:00", complete_until="2024-01-11 00:00:00", bucket_seconds=7000)
    rows = sorted((str(r.triggered_at), r.severity, r.actual_value) for r in got.collect())
    assert rows == [(f"2024-01-10 {at}", s, v) for at, v in [("10:14:00", 170.0), ("11:05:00", 180.0)] for s in ("critical", "warning")]
    operators = {o["operatorName"] for q, _ in ran for p in q.recentProgress for o in p["stateOperators"]}
    assert operators == {"stateStoreSave"} and len(ran) == 3
    assert all(providers(checkpoint) == {"RocksDBStateStoreProvider"} for _, checkpoint in ran)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_daily_statistics_keep_their_state_on_disk(spark, tmp_path, monkeypatch):
    """the default store copies the map of all keys in every micro-batch."""
    from pulsevault.streaming import readings
    monkeypatch.setattr(readings, "scratch_path", lambda spark, name: str(tmp_path / name))
    landing = tmp_path / "landing"
    landing.mkdir()
    landed(landing, [[("2024-01-10T10:14:00", 170.0), ("2024-01-10T10:31:00", 70.0)]])
    got = readings.stream_daily_stats(spark, f"file://{landing}", "2024-01-31 00:00:00")
    assert [(r.reading_count, float(r.value_min), float(r.value_max)) for r in got.collect()] == [(2, 70.0, 170.0)]
    assert providers(tmp_path / "stream-ckpt") == {"RocksDBStateStoreProvider"}
