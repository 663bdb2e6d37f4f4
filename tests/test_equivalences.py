"""Equivalences: rewritten operators equal their literal source forms; incremental == full."""

from pyspark.sql import functions as F

from pulsevault.operators import business as BV
from pulsevault.operators import vault as DV
from pulsevault.plans.lakehouse import Lakehouse

from conftest import SF_SMALL


def _lh(spark):
    return Lakehouse(spark, SF_SMALL, persist_layers=())


def test_range_window_equals_literal_self_join(spark):
    lh = _lh(spark)
    wide = BV.anomaly_pivot(lh.daily_vitals())
    fast = BV.baseline_30d(wide).select("patient_hk", "report_date", "hr_baseline_mean",
                                        F.col("hr_baseline_std").cast("decimal(10,4)").alias("hr_std"))
    c, p = wide.alias("c"), wide.alias("p")
    j = c.join(p, (F.col("p.patient_hk") == F.col("c.patient_hk"))
               & (F.col("p.report_date") >= F.date_sub(F.col("c.report_date"), 30))
               & (F.col("p.report_date") < F.col("c.report_date")))
    from pulsevault.functions import avg_dec
    literal = j.groupBy(F.col("c.patient_hk").alias("patient_hk"), F.col("c.report_date").alias("report_date")).agg(
        avg_dec(F.col("p.hr_mean")).alias("hr_baseline_mean"),
        F.stddev_samp(F.col("p.hr_mean").cast("double")).cast("decimal(10,4)").alias("hr_std"))
    assert fast.count() == literal.count()
    assert fast.exceptAll(literal).count() == 0 and literal.exceptAll(fast).count() == 0


def test_incremental_risk_equals_full(spark):
    lh = _lh(spark)
    risk = lh.risk_profile()
    existing = risk.where(F.col("report_date") <= F.lit("2024-01-15").cast("date"))
    merged = DV.replace_by_key(existing, DV.date_watermark_filter(risk, existing), ["patient_hk", "report_date"])
    assert merged.count() == risk.count()
    assert merged.exceptAll(risk).count() == 0


def test_hub_load_twice_equals_once(spark):
    lh = _lh(spark)
    once = lh.hub_device()
    twice = DV.hub_device(lh.stg_readings(), existing=once)
    assert twice.count() == 0
    assert once.select("device_hk").distinct().count() == once.count()


def test_watermark_on_empty_target_loads_everything(spark):
    lh = _lh(spark)
    stage = lh.sat_reading_value()
    empty = stage.limit(0)
    assert DV.watermark_filter(stage, empty).count() == stage.count()


def test_true_7d_completeness_option(spark):
    lh = _lh(spark)
    lit = BV.completeness_7d(lh.daily_vitals(), lh.anomaly_score())
    true7 = BV.completeness_7d(lh.daily_vitals(), lh.anomaly_score(), true_7d=True)
    assert lit.count() == true7.count()


def test_two_level_breach_windows_equal_single_pass(spark):
    from pulsevault.operators import alerts as AL
    from conftest import SF_MID
    lh = Lakehouse(spark, SF_MID, persist_layers=())
    ref = AL.breach_windows_single_pass(lh.stg_readings())
    for bucket in (600, 3600, 86400):
        got = AL.breach_windows(lh.stg_readings(), bucket_seconds=bucket)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_daily_stats_hash_after_grouping_equals_satellite_form(spark):
    lh = _lh(spark)
    a = BV.daily_stats(lh.sat_reading_value())
    b = BV.daily_stats(lh.stg_readings(), key="patient_id")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
