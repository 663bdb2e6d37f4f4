"""Spark queries vs their DuckDB oracle SQL on sf0.001 (the driver gate runs sf0.01)."""

import collections
import datetime as dt
import decimal

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pulsevault.plans.registry import ORACLE, QUERIES

KEYS = ["stg_readings", "stg_patients", "hub_device", "lnk_patient_device", "sat_reading_value",
        "sat_patient_demographics", "sat_device_spec", "daily_vitals", "anomaly_score", "risk_profile",
        "mart_patient_daily_features", "mart_anomaly_dashboard", "breach_alerts", "change_detect", "patient_enrich",
        "dq_not_null", "dq_relationships", "eda_boxplot", "completeness_7d", "active_alerts", "src_readings"]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("D", str(v))
    if isinstance(v, float):
        return ("F", repr(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("T", v.isoformat())
    return ("V", v)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = sdf.collect()
    rel = duck.sql(E.oracle_sql()[key])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    sc = collections.Counter(tuple(_norm(r[i]) for i in si) for r in srows)
    dc = collections.Counter(tuple(_norm(r[i]) for i in di) for r in drows)
    assert sc == dc


def test_every_key_has_callable_and_most_have_oracles():
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert set(QUERIES) <= set(qs)
    assert set(QUERIES) - set(ORACLE) == {"ml_forest", "ml_metrics", "ml_importance"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "anomaly_next_24h" in df.columns and len(df.columns) == 31


@pytest.mark.parametrize("key", ["fn_iso_ts", "src_readings", "dq_freshness", "stream_daily_stats"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
