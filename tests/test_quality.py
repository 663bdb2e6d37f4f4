"""Data-quality checks must flag injected bad rows and pass clean ones."""

import datetime as dt
from decimal import Decimal

from pulsevault.operators import quality as DQ


def test_not_null_unique_accepted_between(spark):
    df = spark.createDataFrame([("a", "M", 10), ("a", "X", 200), (None, None, None)],
                               "k string, g string, age int")
    assert DQ.not_null_rows(df, "k").count() == 1
    assert DQ.unique_rows(df, ["k"]).count() == 1  # 'a' twice; NULL keys ignored
    assert DQ.accepted_values_rows(df, "g", ["M", "F"]).count() == 1  # NULL passes
    assert DQ.between_rows(df, "age", 0, 130).count() == 1
    rep = {(r.test, r.column_name): r.failures for r in DQ.not_null_summary(df, "m").collect()}
    assert rep == {("not_null", "k"): 1, ("not_null", "g"): 1, ("not_null", "age"): 1}


def test_relationships(spark):
    child = spark.createDataFrame([("x",), ("y",), (None,)], "fk string")
    parent = spark.createDataFrame([("x",)], "pk string")
    assert [r.fk for r in DQ.relationship_rows(child, "fk", parent, "pk").collect()] == ["y"]


def test_range_and_freshness(spark):
    srv = spark.createDataFrame([
        ("r1", "p", "d1", "heart_rate", Decimal("19.0"), dt.datetime(2024, 1, 29, 0, 0), "good", dt.datetime(2024, 1, 31)),
        ("r2", "p", "d1", "heart_rate", Decimal("60.0"), dt.datetime(2024, 1, 29, 1, 0), "good", dt.datetime(2024, 1, 31)),
        ("r3", "p", "d2", "spo2", Decimal("100.5"), dt.datetime(2024, 1, 30, 23, 0), "good", dt.datetime(2024, 1, 31)),
    ], "reading_hk string, patient_hk string, device_hk string, metric_code string, value decimal(10,4), "
       "measured_at timestamp_ntz, quality_flag string, load_datetime timestamp_ntz")
    assert sorted(r.reading_hk for r in DQ.range_violations(srv).collect()) == ["r1", "r3"]
    hub = spark.createDataFrame([("d1", "GRM-W0001"), ("d2", "GRM-W0002")], "device_hk string, device_serial_bk string")
    stale = DQ.stale_devices(srv, hub, "2024-01-31 00:00:00").collect()
    assert [(r.device_hk, r.hours_since_last_reading) for r in stale] == [("d1", 47)]
    fresh = DQ.source_freshness(srv, "2024-02-02 01:30:00").first()
    assert (fresh.hours_since, fresh.status) == (50, "warn")


def test_feeds_and_min_rows(spark):
    """The first and the last expected day are missing, one day is blank."""
    day = lambda k: dt.date(2024, 1, k)
    readings = spark.createDataFrame([("{}", day(2))] * 3 + [("  ", day(2)), ("", day(3)), (" ", day(3)), ("{}", day(4))], "value string, d date")
    alerts = spark.createDataFrame([("{}", day(2))], "value string, d date")
    expected = DQ.expected_days(spark, "2024-01-01", "2024-01-05")
    got = {(x.d.day, x.feed): x.present for x in DQ.feeds_present(expected, {"readings": readings, "alerts": alerts}).collect()}
    assert {k for k, v in got.items() if v} == {(2, "readings"), (4, "readings"), (2, "alerts")} and len(got) == 10
    rows = {r.d.day: (r.line_count, r.passed) for r in DQ.min_rows_per_day(expected, readings, min_rows=3).collect()}
    assert rows == {1: (0, False), 2: (3, True), 3: (0, False), 4: (1, False), 5: (0, False)}


def test_declared_rules_are_complete():
    from pulsevault.plans import data_tests as T
    count = lambda rules: sum(map(len, rules.values()))
    assert (count(T.NOT_NULL), len(T.UNIQUE), count(T.ACCEPTED), len(T.RELATIONSHIPS), count(T.BETWEEN)) == (154, 17, 15, 11, 6)
