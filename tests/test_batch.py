"""The daily batch: incremental runs equal one full build, whatever is delivered again, late, or on another day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pulsevault.operators import affected as AF
from pulsevault.operators import daystate as DS
from pulsevault.operators import marts as MT
from pulsevault.operators import timeline as TL
from pulsevault.operators.keyset import KEYS_PER_BLOCK, KeySet, key_filter, passing
from pulsevault.plans.batch import Warehouse, run_daily_batch
from pulsevault.plans.lakehouse import Lakehouse
from pulsevault.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


@pytest.fixture(scope="module")
def lh(spark):
    return Lakehouse(spark, SF_SMALL)


@pytest.fixture(scope="module")
def two_days(spark, lh):
    """Two loads, the second with late readings of old days, with first days delivered again: once as they were, one
    reading on another day, one without a time, one twice."""
    wh = Warehouse(spark, scratch_path(spark, "t-wh"))
    raw, day = lh.raw_readings(), F.to_date("measured_at")
    number = F.col("reading_id").cast("long")
    old, late = day <= F.lit("2024-01-15").cast("date"), number % 97 == 5
    run_daily_batch(spark, wh, raw.where(old & ~late), lh.raw_patients(), lh.raw_conditions(), "2024-01-16 00:00:00")
    again = raw.where((day == F.lit("2024-01-14").cast("date")) & ~late)
    moved = again.withColumn("measured_at", F.when(number % 2 == 0, F.col("measured_at") - F.expr("INTERVAL 3 DAYS")))
    second = raw.where(~old | late).unionByName(again).unionByName(moved).unionByName(raw.where(~old & (number % 50 == 7)))
    run_daily_batch(spark, wh, second, lh.raw_patients(), lh.raw_conditions(), lh.load_ts)
    assert not moved.where("measured_at is null").isEmpty() and not raw.where(old & late).isEmpty()
    return wh


def test_loads_equal_one_full_build(spark, lh, two_days):
    for name in ("hub_reading", "sat_reading_value", "sat_reading_context"):
        got = two_days.read(name).select("reading_hk")
        assert same(got, getattr(lh, name)().select("reading_hk")), name
    mart = two_days.read("mart_patient_daily_features")
    assert same(mart, lh.mart_patient_daily_features())
    for name in ("daily_vitals", "anomaly_score", "risk_profile"):
        got, want = two_days.read(name).drop("load_datetime"), getattr(lh, name)().drop("load_datetime")
        assert same(got.select(*want.columns), want), name


def test_state_gives_dashboard_vitals_and_alerts(spark, lh, two_days):
    state = two_days.read("patient_state")
    assert same(DS.latest_from_state(state), MT.latest_vitals(lh.sat_reading_value()))
    assert same(DS.value_counts(lh.sat_reading_value()), two_days.read("value_counts").select("patient_hk", "metric_code", "report_date", "value", "n"))


def test_score_state_and_recent_days_give_the_dashboard(spark, lh, two_days):
    as_of = F.lit(MT.DEFAULT_AS_OF).cast("date")
    state = two_days.read("score_state")
    recent = two_days.read("anomaly_score", since="2024-01-25")
    assert same(MT.summary_from_state(state, recent, MT.DEFAULT_AS_OF), MT.score_summary(lh.risk_days(), as_of))
    # alerts are made per delivery: late readings of an old day are not joined with that day's
    board = lambda df: df.drop("active_alerts")
    assert same(board(two_days.read("mart_anomaly_dashboard")), board(lh.mart_anomaly_dashboard()))
    assert "PartitionFilters: [isnotnull(day" in plan(recent) and "2024-01-25" in plan(recent)


def test_score_state_when_days_are_made_anew(spark):
    """Days of one patient each: kept, overtaken, confirmed, taken back (in part: the history must tell), all anew."""
    day = lambda n: dt.date(2024, 1, n)
    scored = "patient_hk string, report_date date, risk_tier string, composite_anomaly_score decimal(8,4), anomaly_flag boolean"
    rows = lambda *r: spark.createDataFrame([(p, day(d), "low", None, flag) for p, d, flag in r], scored)
    before = rows(*[(p, d, d == 9) for p in ("kept", "later", "again", "back", "whole", "gone") for d in (5, 9)], ("back", 4, True), ("whole", 3, True))
    fresh = rows(("later", 12, True), ("again", 9, True), ("back", 9, False), ("whole", 3, False), ("whole", 5, False), ("whole", 9, False), ("new", 2, False))
    units = spark.createDataFrame([("later", day(13), day(14), False), ("again", day(9), day(12), False), ("back", day(9), day(10), False),
                                   ("whole", day(3), day(9), True), ("gone", day(10), day(10), False), ("new", day(2), day(2), False)],
                                  "patient_hk string, lo date, until date, whole boolean")
    got = {r.patient_hk: (r.last and r.last.report_date, r.last_anomaly, r.doubtful)
           for r in DS.merged_scores(DS.score_state(before), fresh, AF.touched_spans(units)).collect()}
    assert got == {"kept": (day(9), day(9), False), "later": (day(12), day(12), False), "again": (day(9), day(9), False),
                   "back": (day(9), None, True), "whole": (day(9), None, False), "gone": (None, None, True), "new": (day(2), None, False)}


def test_a_joined_satellite_is_not_shuffled_and_days_are_pruned(spark, two_days):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = two_days.read("lnk_reading_alert").select("alert_hk", "reading_hk")
        text = plan(links.join(two_days.read("sat_reading_value", [dt.date(2024, 1, 16)]), "reading_hk"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in text and "SelectedBucketsCount: 8 out of 8" in text
    assert "PartitionFilters: [isnotnull(day" in text or "PartitionFilters: [(day" in text
    assert text.count("Exchange") == 1  # of the links


def test_units_cover_what_a_full_timeline_changes(spark):
    """Sparse and dense histories with one changed day each: the units' outputs, made from their context, equal the
    full timeline, and no other row of it differs from before."""
    import random
    rng = random.Random(4)
    rows = []
    for p in range(12):
        d = dt.date(2023, 1, 1)
        for _ in range(rng.choice([3, 40, 120])):
            d += dt.timedelta(days=rng.choice([1, 1, 1, 2, 40 if p % 4 == 3 else 1]))
            rows += [(f"p{p}", m, d, rng.randint(50, 90) + 0.5) for m in ("heart_rate", "spo2", "steps") if rng.random() < 0.9]
    schema = "patient_hk string, metric_code string, report_date date, v double"
    stats = lambda df: df.selectExpr("patient_hk", "metric_code", "report_date", "10L reading_count", "cast(v as decimal(10,4)) value_mean",
                                     *[f"cast(v as decimal(10,4)) {c}" for c in ("value_std", "value_min", "value_max", "value_median", "value_p05", "value_p95")],
                                     "cast(50 as decimal(5,2)) completeness_pct")
    old = spark.createDataFrame(rows, schema)
    picked = {p: rng.choice(sorted({r[2] for r in rows if r[0] == p})) for p in {r[0] for r in rows} if p not in ("p0", "p1")}
    new = spark.createDataFrame([(a, b, c, v + 9 if picked.get(a) == c else v) for a, b, c, v in rows], schema)
    before, after = TL.scored_days(stats(old)).cache(), TL.scored_days(stats(new)).cache()
    changed = spark.createDataFrame([(p, d) for p, d in picked.items()], "patient_hk string, report_date date")
    state = old.groupBy("patient_hk").agg(F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"))
    asked = []

    def known(days):
        asked.append(len(days))
        return before.where(F.col("report_date").isin(days)).select("patient_hk", "report_date")
    units = AF.affected_units(changed, changed.limit(0), state, known)
    got = AF.outputs(TL.scored_days(AF.context(stats(new), units)), units)
    assert same(AF.untouched(before, units).unionByName(got), after)
    assert not same(before, after) and AF.untouched(before, units).count() > before.count() // 4 and len(asked) > 2


def test_keys_are_found_through_the_filter(spark):
    keys = KeySet(spark, scratch_path(spark, "t-keys"), 4)
    named = lambda a, z: spark.range(a, z).selectExpr("md5(cast(id as string)) AS key")
    assert keys.unseen(named(0, 10), "key").count() == 10
    keys.add(named(0, 3000))
    keys.add(named(3000, 9000))
    assert keys.unseen(named(8990, 9100), "key").count() == 100
    assert keys.unseen(named(0, 9000), "key").count() == 0
    assert keys.unseen(named(5, 12), "key", near=named(0, 12)).count() == 0
    assert keys.stored().count() == 9000
    few = keys.known(named(17, 18))
    assert few.count() == 1 and "bucket#" in plan(few) and "PartitionFilters: [isnotnull(bucket" in plan(few)
    blocks = -(-9000 // KEYS_PER_BLOCK)
    passed = passing(named(100_000, 140_000), blocks, key_filter(named(0, 9000), blocks)).count()
    assert passed < 400  # 1 %


def test_a_filter_is_made_block_by_block(spark):
    """keys are shuffled, not the bitmaps of all blocks that every task would make."""
    keys = spark.range(0, 9000, 1, 6).selectExpr("md5(cast(id as string)) AS key")
    made = key_filter(keys, 7)
    text = plan(made)
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange")
    assert made.agg(F.sum("n")).first()[0] == 9000 and made.count() == 7
    assert passing(keys, 7, made).count() == 9000


def test_daily_statistics_from_counts(spark, lh):
    counts = DS.value_counts(lh.sat_reading_value())
    assert same(DS.daily_from_counts(counts, lh.load_ts), lh.daily_vitals())
    assert "Exchange" in plan(counts)
    half = F.xxhash64("reading_hk") % 2 == 0
    srv = lh.sat_reading_value()
    assert same(DS.merged_counts(DS.value_counts(srv.where(half)), DS.value_counts(srv.where(~half))), counts)


def test_the_same_again_changes_nothing_and_a_days_load_rewrites_only_its_days(spark, lh, two_days):
    """Last, as it adds to the warehouse: a day again, as it was, and some new readings of the last day."""
    names = ["hub_reading", "sat_reading_value", "daily_vitals", "mart_patient_daily_features", "mart_anomaly_dashboard"]
    before = {n: two_days.read(n).count() for n in names}
    stamp = lambda: {r.day: r.t for r in spark.read.parquet(two_days.path("anomaly_score")).groupBy("day").agg(
        F.max("_metadata.file_modification_time").alias("t")).collect()}
    written = stamp()
    raw, day = lh.raw_readings(), F.to_date("measured_at")
    last = raw.agg(F.max(day)).first()[0]
    some = raw.where((day == F.lit(last)) & (F.col("reading_id").cast("long") % 5 == 1)).withColumn("reading_id", F.concat(F.lit("new-"), "reading_id"))
    run_daily_batch(spark, two_days, raw.where(day == F.lit("2024-01-20").cast("date")).unionByName(some), lh.raw_patients(), lh.raw_conditions(), lh.load_ts)
    after = {n: two_days.read(n).count() for n in names}
    assert after == {n: before[n] + (some.count() if n in ("hub_reading", "sat_reading_value") else 0) for n in names}
    changed = {d for d, t in stamp().items() if written.get(d) != t}
    assert last in changed and changed <= {last, last - dt.timedelta(days=1)}
    report = two_days.read("data_tests").groupBy("model", "test", "column_name").agg(F.sum("failures").alias("f"), F.sum("n_rows").alias("n"))
    rows = {(r.model, r.test, r.column_name): (r.f, r.n) for r in report.collect()}
    assert rows["hub_reading", "not_null", "reading_hk"] == (0, after["hub_reading"])
    assert rows["sat_reading_value", "not_null", "measured_at"] == (two_days.read("sat_reading_value").where("measured_at is null").count(), after["hub_reading"])
