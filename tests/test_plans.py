"""Plan-shape checks: the properties that matter at scale, asserted on physical plans."""

import pytest
from pyspark.sql import functions as F

from pulsevault.plans.lakehouse import Lakehouse

from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lh(spark):
    return Lakehouse(spark, SF_SMALL, persist_layers=())


@pytest.mark.parametrize("layer", ["daily_vitals", "anomaly_score", "risk_profile", "mart_patient_daily_features",
                                   "mart_anomaly_dashboard", "breach_windows", "patients_enriched"])
def test_no_cross_products(lh, layer):
    plan = _plan(getattr(lh, layer)())
    for bad in FORBIDDEN:
        assert bad not in plan, f"{layer} plan contains {bad}"


def test_daily_aggregate_is_partial_before_shuffle(lh):
    plan = _plan(lh.daily_vitals())
    # a partial aggregate must sit below the shuffle exchange (map-side combine)
    assert "partial_" in plan and "Exchange hashpartitioning" in plan


def test_scan_prunes_columns(lh):
    plan = _plan(lh.daily_vitals())
    # props (the JSON column) is not needed for daily statistics and must not be read
    read_schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert read_schema and all("props" not in ln for ln in read_schema)


def test_metric_filter_pushed_to_scan(lh):
    from pulsevault.operators.marts import latest_vitals
    plan = _plan(latest_vitals(lh.sat_reading_value()))
    assert "PushedFilters" in plan and "event_type" in plan


def test_dense_index_has_no_single_partition_data_window(lh, spark):
    from pulsevault.operators.patients import dense_index
    df = dense_index(lh.stg_patients().select("patient_id"), "patient_id")
    idx = sorted(r.idx for r in df.collect())
    assert idx == list(range(len(idx)))
    final = _plan(df).split("== Initial Plan ==")[0]
    # the only single-partition step is the per-partition offsets table (one row per partition)
    assert final.count("SinglePartition") <= 1


@pytest.mark.parametrize("partitions", [4, 8, 200])
def test_dense_index_of_wide_rows_at_any_partitioning(spark, partitions):
    """Rows beyond the range sampler's reach, with a payload, at several partition counts."""
    from pulsevault.operators.patients import dense_index
    n = 15_000
    keys = spark.range(n).select(F.format_string("p%06d", (F.col("id") * 7919) % n).alias("k"), "id")
    wide = keys.select("k", *[F.md5(F.concat("k", F.lit(str(i)))).alias(f"c{i}") for i in range(12)]).repartition(7)
    got = dense_index(wide, "k", "idx", partitions)
    bad = got.where(F.col("idx") != F.substring("k", 2, 6).cast("long")).count()
    assert (got.count(), got.select("idx").distinct().count(), bad) == (n, n, 0)
