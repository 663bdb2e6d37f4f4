"""Structured Streaming slice over the NDJSON landing tree (extension named by the source as
future work): file source -> staging projection -> watermark + in-watermark dedup ->
daily tumbling-window statistics, delivered with ``foreachBatch`` to an append-only Parquet
log and resolved to the final value per key by batch id.

Update mode emits each changed window once per micro-batch; the last emission per key is
the final state, so the resolved table equals the batch aggregation when no row is later
than the watermark. Rows later than the watermark are dropped (unlike batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsevault.functions import event_time
from pulsevault.operators.staging import stg_readings
from pulsevault.session import scratch_path, state_on_disk
from pulsevault.sources.schemas import READINGS_SCHEMA

STREAM_KEYS = ["patient_id", "metric_code", "report_date"]


def readings_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(READINGS_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing_root)


def daily_window_stats(stream: DataFrame, load_ts: str, watermark: str = "2 hours") -> DataFrame:
    """Staged readings -> dedup on reading_id within the watermark -> 1-day tumbling windows."""
    # Watermarks need a TIMESTAMP instant: the NTZ wall clock read as UTC (zone-independent).
    s = stg_readings(stream, load_ts).withColumn("event_time", event_time("measured_at")) \
        .withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["reading_id"])
    g = s.groupBy(F.window("event_time", "1 day"), "patient_id", "metric_code").agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    )
    day = F.date_from_unix_date((F.unix_micros(F.col("window.start")) / F.lit(86_400_000_000)).cast("int"))
    return g.select("patient_id", "metric_code", day.alias("report_date"),
                    "reading_count", "value_min", "value_max")


def run_to_table(spark: SparkSession, agg: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Run the stream over all available files (``availableNow``), logging every micro-batch's
    updated rows with its batch id, then resolve the latest value per key."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out_path)

    with state_on_disk(spark):
        q = (agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    log = spark.read.parquet(out_path)
    w = Window.partitionBy(*STREAM_KEYS).orderBy(F.col("batch_id").desc())
    return log.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "batch_id")


def stream_daily_stats(spark: SparkSession, landing_root: str, load_ts: str, watermark: str = "2 hours",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    agg = daily_window_stats(readings_stream(spark, landing_root, max_files_per_trigger), load_ts, watermark)
    return run_to_table(spark, agg, scratch_path(spark, "stream-daily"), scratch_path(spark, "stream-ckpt"))
