"""Which patient-days of the scores and marts a changed day touches, and what is needed to make them anew.

Outputs of the fused timeline depend on neighbouring days of the same patient: the baseline on the
``ANOMALY_BASELINE_DAYS`` days before, the rolling vitals on 6 rows before, the rolling scores on 29 scored
rows before, the label on the day after. A changed day therefore touches the day before it, itself, and
what follows up to the 29th scored row after the baseline's reach.

``affected_units`` cuts the changed days of every patient into units (runs of changed days that lie close
together), each with its outputs (``lo`` - 1 to ``until``) and the context to read (``start`` to ``until`` + 1).
Scored rows are counted from the stored scores, in widening stretches of days, until every unit has 29 or
reaches its patient's first or last day: after an ordinary daily load that is one stretch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.fixed_values import ANOMALY_BASELINE_DAYS
from pulsevault.session import scratch_path

#: Scored rows before a row that its rolling scores need.
ROWS_BEFORE = 29
#: Changed days of a patient that are further apart make units of their own.
APART = 75
#: Days of the first stretch in which scored rows are counted; each further one is four times as long.
STRETCH = 64


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def days_between(spans: DataFrame, first: Column, last: Column) -> list:
    """The distinct days of all spans (at most one per day of the calendar that they cover)."""
    days = spans.select(first.alias("a"), last.alias("z")).where("a <= z").select(F.explode(F.sequence("a", "z")).alias("d"))
    return sorted(r["d"] for r in days.distinct().collect())


def _reach(units: DataFrame, scored_days: Callable[[list], DataFrame], forward: bool) -> DataFrame:
    """(unit, reach): the day of the 29th scored row beyond a unit's changed days, else null if the patient's
    first or last day is nearer."""
    width, pending, found = STRETCH, units, None
    while True:
        if forward:
            first = F.date_add("hi", ANOMALY_BASELINE_DAYS + 1)
            far = F.date_add("hi", ANOMALY_BASELINE_DAYS + width)
            spans = pending.select("unit", "patient_hk", first.alias("a"), F.least(far, F.col("last_day")).alias("z"), (far >= F.col("last_day")).alias("whole_way"))
        else:
            far = F.date_sub("lo", 1 + width)
            spans = pending.select("unit", "patient_hk", F.greatest(far, F.col("first_day")).alias("a"), F.date_sub("lo", 2).alias("z"), (far <= F.col("first_day")).alias("whole_way"))
        rows = scored_days(days_between(spans, F.col("a"), F.col("z")))
        near = spans.join(rows, "patient_hk").where(F.col("report_date").between(F.col("a"), F.col("z")))
        order = F.col("report_date").asc() if forward else F.col("report_date").desc()
        nth = near.withColumn("k", F.row_number().over(Window.partitionBy("unit").orderBy(order))).where(F.col("k") == ROWS_BEFORE)
        step = _stored(spans.join(nth.select("unit", F.col("report_date").alias("reach")), "unit", "left"), "affected-reach")
        settled = step.where(F.col("reach").isNotNull() | F.col("whole_way")).select("unit", "reach")
        found = settled if found is None else found.unionByName(settled)
        left = step.where(F.col("reach").isNull() & ~F.col("whole_way"))
        if left.isEmpty():
            return found
        pending, width = units.join(left.select("unit"), "unit", "left_semi"), width * 4


def affected_units(changed: DataFrame, whole: DataFrame, state: DataFrame, scored_days: Callable[[list], DataFrame]) -> DataFrame:
    """Units (unit, patient_hk, lo, until, start, whole) for ``changed`` (patient_hk, report_date); the patients of
    ``whole`` (patient_hk) are one unit each with all their days. ``state``: first and last day per patient;
    ``scored_days(days)``: (patient_hk, report_date) of the stored scores on these days."""
    spans = state.select("patient_hk", "first_day", "last_day")
    all_of = whole.select("patient_hk").distinct().join(spans, "patient_hk").select(
        F.concat("patient_hk", F.lit("|all")).alias("unit"), "patient_hk", F.col("first_day").alias("lo"), F.col("last_day").alias("until"),
        F.col("first_day").alias("start"), F.lit(True).alias("whole"))
    w = Window.partitionBy("patient_hk").orderBy("report_date")
    days = changed.where("report_date is not null").join(whole.select("patient_hk").distinct(), "patient_hk", "left_anti")
    days = days.withColumn("new", F.coalesce(F.datediff("report_date", F.lag("report_date").over(w)) > APART, F.lit(False)).cast("int"))
    days = days.withColumn("run", F.sum("new").over(w))
    runs = days.groupBy("patient_hk", "run").agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
    runs = runs.withColumn("next_lo", F.lead("lo").over(Window.partitionBy("patient_hk").orderBy("lo")))
    units = _stored(runs.join(spans, "patient_hk").withColumn("unit", F.concat_ws("|", "patient_hk", "run")), "affected-runs")
    before = _reach(units, scored_days, False).withColumnRenamed("reach", "before")
    after = _reach(units, scored_days, True).withColumnRenamed("reach", "after")
    units = units.join(before, "unit").join(after, "unit")
    until = F.greatest(F.coalesce("after", "last_day"), F.col("hi"))
    start = F.coalesce(F.date_sub("before", ANOMALY_BASELINE_DAYS), "first_day")
    units = units.select("unit", "patient_hk", "lo", F.least(until, F.coalesce(F.date_sub("next_lo", 2), until)).alias("until"), start.alias("start"),
                         F.lit(False).alias("whole"))
    units = units.unionByName(all_of).join(spans.select("patient_hk", "first_day"), "patient_hk")
    # rows without a day come before all others: they are context where the context starts with the first day
    return _stored(units.withColumn("undated", F.col("whole") | (F.col("start") <= F.col("first_day"))).drop("first_day"), "affected-units")


def context(daily: DataFrame, units: DataFrame) -> DataFrame:
    """The daily rows that the units need, each unit as a patient of its own (``patient_hk`` is the unit)."""
    u = units.select("unit", F.col("patient_hk").alias("__of"), "start", "until", "undated")
    day = F.col("report_date")
    j = daily.join(u, F.col("patient_hk") == F.col("__of")).where(
        day.between(F.col("start"), F.date_add("until", 1)) | (day.isNull() & F.col("undated")))
    return j.select(*[F.col("unit").alias("patient_hk") if c == "patient_hk" else F.col(c) for c in daily.columns])


def _in_outputs(day: Column) -> Column:
    return F.col("whole") | day.between(F.date_sub("lo", 1), F.col("until"))


def outputs(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Of rows keyed by unit, those that the unit touches, keyed by patient again."""
    u = units.select(F.col("unit").alias("__unit"), F.col("patient_hk").alias("__of"), "lo", "until", "whole")
    j = rows.join(u, F.col("patient_hk") == F.col("__unit")).where(_in_outputs(F.col("report_date")))
    return j.select(*[F.col("__of").alias("patient_hk") if c == "patient_hk" else F.col(c) for c in rows.columns])


def _touch(rows: DataFrame, units: DataFrame, how: str) -> DataFrame:
    u = units.select(F.col("patient_hk").alias("__of"), "lo", "until", "whole")
    return rows.join(u, (rows.patient_hk == F.col("__of")) & (F.col("whole") | rows.report_date.between(F.date_sub("lo", 1), F.col("until"))), how)


def untouched(rows: DataFrame, units: DataFrame) -> DataFrame:
    """The stored rows that no unit touches."""
    return _touch(rows, units, "left_anti")


def touched(rows: DataFrame, units: DataFrame) -> DataFrame:
    """The rows that some unit touches."""
    return _touch(rows, units, "left_semi")


def touched_spans(units: DataFrame) -> DataFrame:
    """(patient_hk, whole, spans): the days that the units of a patient touch, as (a, z); units lie ``APART`` days
    apart, so a patient's list is short."""
    return units.groupBy("patient_hk").agg(
        F.max("whole").alias("whole"), F.collect_list(F.struct(F.date_sub("lo", 1).alias("a"), F.col("until").alias("z"))).alias("spans"))
