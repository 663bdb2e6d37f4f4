"""File sources (SRC1-SRC4, SRC6): CSV exports and the day-partitioned NDJSON landing tree.

All readers are lazy scans with explicit types, so Spark splits files across tasks and
prunes columns; nothing is read on the driver except the CSV header line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsevault.sources.schemas import ALERTS_SCHEMA, READINGS_SCHEMA


def _normalise_names(df: DataFrame) -> DataFrame:
    """STR8: trim + lower-case every column name (Synthea headers are upper-case)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column a string (no inference), names normalised."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("mode", "PERMISSIVE").csv(path))
    return _normalise_names(df)


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: Synthea patients.csv."""
    return read_csv_strings(spark, path)


def read_conditions(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: Synthea conditions.csv (start, stop, patient, encounter, code, description)."""
    return read_csv_strings(spark, path)


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: NDJSON readings (file, directory or landing tree); nested ``context`` stays raw JSON text."""
    return spark.read.schema(READINGS_SCHEMA).json(path).select(*READINGS_SCHEMA.fieldNames())


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: NDJSON alerts."""
    return spark.read.schema(ALERTS_SCHEMA).json(path).select(*ALERTS_SCHEMA.fieldNames())


def read_day_slice(spark: SparkSession, root: str, day: str, schema=READINGS_SCHEMA) -> DataFrame:
    """SRC6: one load date of a landing tree partitioned as ``d=YYYY-MM-DD``.

    The date predicate is on the partition column, so Spark lists and reads only that
    directory (PartitionFilters in the scan), however many days the tree holds.
    """
    df = spark.read.schema(schema).json(root) if schema is not None else spark.read.json(root)
    return df.where(F.col("d") == F.lit(day).cast("date")).drop("d")
