"""Patient enrichment (EN1, EN2, JN10, SET2/ARR4, STR9).

The source numbers patients by file position to assign devices round-robin. A global
``row_number()`` without a partition runs in one task, so ``dense_index`` computes the same
0-based position with a range partition of the keys: the partitioned keys are stored once, counts
per partition (one row each) give the offsets, a row_number inside each partition does the rest,
and the payload is joined back on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.fixed_values import (
    CGM_MODELS, CGM_SERIAL_FORMAT, DEVICE_MODELS, SMARTWATCH_MODELS, SNOMED_CARDIAC, SNOMED_DIABETES,
    SNOMED_HYPERTENSION, WATCH_SERIAL_FORMAT,
)
from pulsevault.session import scratch_path


def dense_index(df: DataFrame, order_col: str, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_col`` order (unique, non-null order values), without
    a single-partition window. A range exchange samples its bounds each time it is planned, so the
    key's partition number is stored: counts and positions come from the same partitioning."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "dense-index")
    df.select(order_col).repartitionByRange(n, order_col).withColumn("__pid", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: this window is tiny by construction.
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__pid").orderBy(order_col)))
    index = local.join(F.broadcast(offsets), "__pid").select(order_col, (F.col("__off") + F.col("__local") - 1).alias(name))
    return df.join(index, order_col)


def _model_at(models, idx_col):
    """Pick ``models[idx % len(models)]`` as (model, manufacturer) columns."""
    k = len(models)
    model = None
    maker = None
    for i, (mname, mmaker, _, _) in enumerate(models):
        cond = (idx_col % k) == i
        model = F.when(cond, mname) if model is None else model.when(cond, mname)
        maker = F.when(cond, mmaker) if maker is None else maker.when(cond, mmaker)
    return model, maker


def patient_condition_codes(stg_conditions: DataFrame) -> DataFrame:
    """JN10: all codes per patient (resolved ones included, Q7), sorted. The collect is of (code, n) pairs;
    the source keeps repeats, so the list itself is as long as the patient has condition rows."""
    per_code = stg_conditions.groupBy("patient_id", "condition_code").agg(F.count(F.lit(1)).alias("n"))
    return per_code.groupBy("patient_id").agg(F.array_sort(F.collect_list(F.struct("condition_code", "n"))).alias("__c")) \
        .select("patient_id", F.flatten(F.transform("__c", lambda s: F.array_repeat(s["condition_code"], s["n"].cast("int"))))
                .alias("condition_codes"))


def enrich_patients(stg_patients: DataFrame, stg_conditions: DataFrame) -> DataFrame:
    """EN1: condition list, three SNOMED flags by set overlap, round-robin smartwatch by position,
    a CGM for diabetics."""
    codes = patient_condition_codes(stg_conditions)
    p = stg_patients.select("patient_id", "birth_date", "gender", "race", "ethnicity", "city", "state", "bmi")
    p = dense_index(p, "patient_id", "idx").join(codes, "patient_id", "left")
    cc = F.coalesce(F.col("condition_codes"), F.array().cast("array<string>"))

    def has(cs):
        return F.arrays_overlap(cc, F.array(*[F.lit(c) for c in cs]))
    watch_model, watch_maker = _model_at(SMARTWATCH_MODELS, F.col("idx"))
    cgm_model, cgm_maker = _model_at(CGM_MODELS, F.col("idx"))
    diabetic = has(SNOMED_DIABETES)
    return p.select(
        "patient_id", "idx", "birth_date", "gender", "race", "ethnicity", "city", "state", "bmi",
        F.array_join(cc, ",").alias("chronic_conditions"),
        diabetic.alias("has_diabetes"),
        has(SNOMED_HYPERTENSION).alias("has_hypertension"),
        has(SNOMED_CARDIAC).alias("has_cardiac_condition"),
        F.format_string(WATCH_SERIAL_FORMAT, F.col("idx")).alias("device_serial"),
        watch_model.alias("device_model"),
        watch_maker.alias("device_manufacturer"),
        F.when(diabetic, F.format_string(CGM_SERIAL_FORMAT, F.col("idx"))).alias("cgm_serial"),
        F.when(diabetic, cgm_model).alias("cgm_model"),
        F.when(diabetic, cgm_maker).alias("cgm_manufacturer"),
    )


def device_catalog(spark) -> DataFrame:
    """Device catalogue: four fixed rows (broadcast-safe)."""
    return spark.createDataFrame([(m, mk, t, list(ms)) for m, mk, t, ms in DEVICE_MODELS],
                                 "model string, manufacturer string, type string, metrics array<string>")


def metrics_supported(enriched: DataFrame) -> DataFrame:
    """EN2: ordered distinct union of the watch's and (for diabetics) the CGM's metric lists."""
    cat = F.broadcast(device_catalog(enriched.sparkSession))
    w = cat.select(F.col("model").alias("device_model"), F.col("metrics").alias("__wm"))
    c = cat.select(F.col("model").alias("cgm_model"), F.col("metrics").alias("__cm"))
    j = enriched.join(w, "device_model", "left").join(c, "cgm_model", "left")
    empty = F.array().cast("array<string>")
    cgm = F.when(F.col("has_diabetes") & F.col("cgm_model").isNotNull(), F.coalesce("__cm", empty)).otherwise(empty)
    return j.select("patient_id", F.array_distinct(F.concat(F.coalesce("__wm", empty), cgm)).alias("metrics_supported"))
