"""Data-quality checks (DQ1-DQ11). A check yields offending rows; empty means pass.

Row-level functions return the failing rows themselves. The ``*_summary`` helpers fuse many
checks on one table into a single aggregate pass (``count_if`` per column, then an unpivot),
returning one row per (model, test, column) with the failure count — the shape of a test report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsevault.fixed_values import (
    DEVICE_STALE_HOURS, HR_PLAUSIBLE, LANDING_MIN_ROWS, LANDING_REQUIRED_FEEDS, SOURCE_FRESHNESS_ERROR_HOURS,
    SOURCE_FRESHNESS_WARN_HOURS, SPO2_PLAUSIBLE,
)
from pulsevault.functions import hours_between

REPORT_SCHEMA = "model string, test string, column_name string, failures bigint"


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _report(df: DataFrame, model: str, test: str, counts: dict[str, Column]) -> DataFrame:
    """One aggregate pass over ``df``; unpivot the per-column counts into report rows."""
    agg = df.agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(counts.values())])
    cols = list(counts)
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.coalesce(F.col(f"c{i}"), F.lit(0).cast("long")).alias("failures"))
        for i, name in enumerate(cols)])).alias("r"))
    return stacked.select(F.lit(model).alias("model"), F.lit(test).alias("test"), "r.column_name", "r.failures")


# -- DQ1 not_null ---------------------------------------------------------------------------

def not_null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_null_summary(df: DataFrame, model: str, columns: list[str] | None = None) -> DataFrame:
    cols = columns or df.columns
    return _report(df, model, "not_null", {c: F.count_if(F.col(c).isNull()) for c in cols})


# -- DQ2 unique (NULLs ignored) ----------------------------------------------------------------

def unique_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values seen more than once, with their counts."""
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(nn).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_summary(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    dups = unique_rows(df, columns)
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique").alias("test"),
        F.lit(",".join(columns)).alias("column_name"), F.col("failures").cast("long"))


# -- DQ3 accepted_values (NULL passes) ------------------------------------------------------------

def accepted_values_rows(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def accepted_values_summary(df: DataFrame, model: str, rules: dict[str, list[str]]) -> DataFrame:
    return _report(df, model, "accepted_values",
                   {c: F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in rules.items()})


# -- DQ4 relationships ------------------------------------------------------------------------------

def relationship_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join)."""
    p = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(p, column, "left_anti")


def relationship_summary(child: DataFrame, model: str, column: str, parent: DataFrame, parent_model: str,
                         parent_column: str) -> DataFrame:
    return relationship_rows(child, column, parent, parent_column).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(f"relationships:{parent_model}.{parent_column}").alias("test"),
        F.lit(column).alias("column_name"), F.col("failures").cast("long"))


# -- DQ5 between (NULL passes) ------------------------------------------------------------------------

def between_rows(df: DataFrame, column: str, lo, hi) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).between(lo, hi))


def between_summary(df: DataFrame, model: str, rules: dict[str, tuple]) -> DataFrame:
    return _report(df, model, "between",
                   {c: F.count_if(F.col(c).isNotNull() & ~F.col(c).between(lo, hi)) for c, (lo, hi) in rules.items()})


def row_tests(not_null: list[str], accepted: dict[str, list[str]], between: dict[str, tuple]) -> list[tuple[str, str, Column]]:
    """(test, column, whether a row fails) of the tests that look at one row at a time; countable while a table
    is written (``DataFrame.observe``) as well as afterwards."""
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in accepted.items()]
    return tests + [("between", c, F.col(c).isNotNull() & ~F.col(c).between(*b)) for c, b in between.items()]


# -- DQ6/DQ7 plausible ranges on raw readings --------------------------------------------------------------

def range_violations(sat_reading_value: DataFrame) -> DataFrame:
    """Heart rate outside 20-300 and SpO2 outside 70-100 (strict), as one union of failing rows."""
    def one(metric, lo, hi, test):
        v = F.col("value")
        return sat_reading_value.where((F.col("metric_code") == metric) & ((v < lo) | (v > hi))).select(
            F.lit(test).alias("test"), "reading_hk", "patient_hk", "measured_at", "value", "quality_flag",
            "load_datetime")
    return one("heart_rate", *HR_PLAUSIBLE, "assert_hr_in_range").unionByName(
        one("spo2", *SPO2_PLAUSIBLE, "assert_spo2_in_range"))


# -- DQ8 device freshness -----------------------------------------------------------------------------------

def stale_devices(sat_reading_value: DataFrame, hub_device: DataFrame, as_of_ts: str,
                  stale_hours: int = DEVICE_STALE_HOURS) -> DataFrame:
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    last = sat_reading_value.groupBy("device_hk").agg(F.max("measured_at").alias("last_seen_at"))
    j = hub_device.select("device_hk", "device_serial_bk").join(last, "device_hk")
    return j.select("device_hk", "device_serial_bk", "last_seen_at",
                    hours_between("last_seen_at", now).alias("hours_since_last_reading")) \
        .where(F.col("hours_since_last_reading") > stale_hours)


# -- DQ9 source freshness ---------------------------------------------------------------------------------------

def source_freshness(stg_readings: DataFrame, as_of_ts: str, warn_hours: int = SOURCE_FRESHNESS_WARN_HOURS,
                     error_hours: int = SOURCE_FRESHNESS_ERROR_HOURS) -> DataFrame:
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    m = stg_readings.agg(F.max("measured_at").alias("max_loaded_at"))
    h = hours_between("max_loaded_at", now)
    return m.select("max_loaded_at", h.alias("hours_since"),
                    F.when(F.col("max_loaded_at").isNull() | (h > error_hours), "error")
                    .when(h > warn_hours, "warn").otherwise("pass").alias("status"))


# -- DQ10 landing gate: feeds present per day --------------------------------------------------------------------

def expected_days(spark, first: str, last: str) -> DataFrame:
    """One row per load date from ``first`` to ``last`` (the dates that the schedule names, whether or
    not anything landed)."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d"))


def feeds_present(expected: DataFrame, feed_lines: dict[str, DataFrame], required: list[str] = LANDING_REQUIRED_FEEDS) -> DataFrame:
    """(day, feed, present) for every expected day and required feed. ``feed_lines`` maps a feed name to the
    lines of its day-partitioned landing tree (columns value, d); a day is present if it has a file with
    a line that is not blank."""
    found = _union([df.where(F.trim("value") != "").select("d").distinct().withColumn("feed", F.lit(name)) for name, df in feed_lines.items()])
    feeds = expected.select("d", F.explode(F.array(*[F.lit(f) for f in required])).alias("feed"))
    return feeds.join(found.withColumn("present", F.lit(True)), ["d", "feed"], "left") \
        .select("d", "feed", F.coalesce("present", F.lit(False)).alias("present"))


# -- DQ11 landing gate: minimum non-blank rows per day file ------------------------------------------------------

def min_rows_per_day(expected: DataFrame, text_lines: DataFrame, min_rows: int = LANDING_MIN_ROWS) -> DataFrame:
    """Non-blank lines of every expected day against the minimum; a day without a file, or with an empty or
    blank one, has 0 lines and fails. ``text_lines``: lines of a day-partitioned landing tree (value, d)."""
    counted = text_lines.where(F.trim("value") != "").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(counted, "d", "left").select(
        "d", F.coalesce("n", F.lit(0)).alias("line_count"), (F.coalesce("n", F.lit(0)) >= min_rows).alias("passed"))
