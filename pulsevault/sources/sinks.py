"""Sinks (SNK1-SNK7): views, keyed appends, partitioned and NDJSON writes, snapshots, compaction.

Paths are Spark URIs; on a cluster they live on shared storage (the tests use folders under
``spark.checkpoint.dir``). Writes are idempotent per target: overwrite replaces whole
partitions (dynamic mode), appends go through a keyed anti join first.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def path_missing(err: Exception) -> bool:
    """True only for Spark's "path does not exist" error (other read failures must surface)."""
    from pyspark.errors import AnalysisException
    return isinstance(err, AnalysisException) and err.getCondition() == "PATH_NOT_FOUND"


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path)
    except Exception as err:  # noqa: BLE001
        if path_missing(err):
            return None
        raise


def cluster_by_partition(df: DataFrame, part_col: str, splits: int = 8) -> DataFrame:
    """Cluster rows by an output partition column without letting a hot value land in one task.

    Hash partitioning on (partition value, row hash modulo ``splits``): each value is written by at most
    ``splits`` tasks, a hot one by that many. A range partitioning would run the upstream plan an extra
    time to sample its bounds. The hash (not ``rand()``) keeps the placement identical when a stage is
    retried after an executor loss.
    """
    from pyspark.sql.types import MapType
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return df.repartition(part_col, F.pmod(F.xxhash64(*hashable), F.lit(splits)))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SNK1: register a lazy staging view (no data is written)."""
    df.createOrReplaceTempView(name)
    return df


def append_new(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """SNK2: insert-only append — rows whose key is not yet in the target, then ``mode('append')``."""
    existing = read_if_exists(spark, path)
    new = df if existing is None else df.join(existing.select(*keys), keys, "left_anti")
    new.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK3: full refresh (or, with ``partition_by``, dynamic overwrite of the touched partitions)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitioned_by_day(df: DataFrame, path: str, ts_col: str = "measured_at", part_col: str = "measured_date",
                             max_records_per_file: int = 5_000_000) -> None:
    """SNK4: Parquet partitioned by ``day(ts_col)``.

    Clustering by the day column gives every partition directory few, large files; a heavy day
    is spread over several writer tasks; ``maxRecordsPerFile`` bounds file size.
    """
    out = df.withColumn(part_col, F.to_date(ts_col))
    (cluster_by_partition(out, part_col).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(part_col).parquet(path))


def write_ndjson_by_day(df: DataFrame, path: str, ts_col: str, iso_cols: list[str] | None = None,
                        json_cols: list[str] | None = None, part_col: str = "d") -> None:
    """SNK5: NDJSON landing tree, one directory per day (``d=YYYY-MM-DD``).

    Timestamps are written as ISO-8601 text with a ``Z`` suffix; raw-JSON text columns in
    ``json_cols`` are written as nested objects (parsed with their inferred-free schema by
    ``from_json`` over a MAP), matching the feed shape.
    """
    out = df.withColumn(part_col, F.to_date(ts_col))
    for c in iso_cols or [ts_col]:
        out = out.withColumn(c, F.date_format(c, ISO_FORMAT))
    for c in json_cols or []:
        out = out.withColumn(c, F.from_json(c, "map<string,string>"))
    cluster_by_partition(out, part_col).write.mode("overwrite").partitionBy(part_col).json(path)


def write_csv(df: DataFrame, path: str, header_names: dict[str, str] | None = None) -> None:
    """CSV export with a header (e.g. the upper-case export column names)."""
    out = df.toDF(*[(header_names or {}).get(c, c) for c in df.columns])
    out.write.mode("overwrite").option("header", True).csv(path)


# -- day tables: rewritten by whole days, or bucketed for joins that leave them where they are ------------------

def read_days(df: DataFrame, days: list | None, part_col: str = "day") -> DataFrame:
    """The partitions of ``days`` (None among them: rows without a day) as a literal partition filter."""
    if days is None:
        return df
    dated = [d for d in days if d is not None]
    some = F.col(part_col).isin(dated)
    return df.where(some if len(dated) == len(days) else some | F.col(part_col).isNull())


def overwrite_days(spark: SparkSession, df: DataFrame, path: str, part_col: str = "day") -> None:
    """Replace the day partitions that ``df`` has rows for; the others keep their files. ``df`` may read them:
    it is stored in the shared scratch folder first."""
    from pulsevault.session import scratch_path
    kept = scratch_path(spark, "days")
    df.write.parquet(kept)
    rows = spark.read.schema(df.schema).parquet(kept)
    (cluster_by_partition(rows, part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))


class BucketedTable:
    """Parquet partitioned by ``part_col`` and bucketed by ``key``: a join on the key shuffles only its other
    side. The bucketing is declared in the session's catalog over the table's path."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int, part_col: str = "day"):
        self.spark, self.path, self.key, self.buckets, self.part_col = spark, path, key, buckets, part_col
        self.name = "bucketed_" + hashlib.md5(path.encode()).hexdigest()

    def _declare(self, schema) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString() if f.name != self.part_col else 'date'}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet PARTITIONED BY ({self.part_col}) CLUSTERED BY ({self.key}) "
                       f"SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.name):
            df = read_if_exists(self.spark, self.path)
            if df is None:
                return None
            self._declare(df.schema)
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.spark.table(self.name)

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows dealt as the buckets are: every bucket is written by one task, so as one file a day."""
        return df.repartition(self.buckets, self.key)

    def append(self, dealt: DataFrame) -> None:
        """Append ``dealt`` rows (``part_col`` last)."""
        if self.read() is None:
            self._declare(dealt.schema)
        dealt.write.insertInto(self.name)


# -- SNK6 snapshots ----------------------------------------------------------------------------------------

def write_snapshot(spark: SparkSession, df: DataFrame, root: str) -> int:
    """Write a new immutable version ``root/v=<n>`` and record it in a JSON manifest; returns n.

    The manifest is a tiny text dataset written by Spark (one line per version), so readers
    can pin a version without listing data files.
    """
    versions = list_snapshots(spark, root)
    n = (max(versions) + 1) if versions else 1
    df.write.mode("overwrite").parquet(f"{root}/v={n}")
    spark.createDataFrame([(json.dumps({"version": n, "path": f"{root}/v={n}"}),)], "value string") \
        .write.mode("append").text(f"{root}/_manifest")
    return n


def list_snapshots(spark: SparkSession, root: str) -> list[int]:
    manifest = read_if_exists(spark, f"{root}/_manifest", "text")
    if manifest is None:
        return []
    return sorted(json.loads(r.value)["version"] for r in manifest.collect())  # one short line per version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """SNK6: read a pinned version (latest when ``version`` is None)."""
    versions = list_snapshots(spark, root)
    if not versions:
        raise FileNotFoundError(f"no snapshots under {root}")
    v = versions[-1] if version is None else version
    if v not in versions:
        raise KeyError(f"snapshot v={v} not in {versions}")
    return spark.read.parquet(f"{root}/v={v}")


# -- SNK7 compaction -------------------------------------------------------------------------------------------

def compact_partitions(spark: SparkSession, src: str, dst: str, part_col: str,
                       target_rows_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite a day-partitioned table with few files per partition.

    Rows are clustered by the partition column (one shuffle, hot partitions split over several
    tasks) and written as large files; ``maxRecordsPerFile`` bounds file size.
    Written to a new location, then read back (readers switch paths atomically).
    """
    df = spark.read.parquet(src)
    (cluster_by_partition(df, part_col).write.mode("overwrite").option("maxRecordsPerFile", target_rows_per_file)
     .partitionBy(part_col).parquet(dst))
    return spark.read.parquet(dst)


def small_file_partitions(spark: SparkSession, path: str, part_col: str, target_bytes: int) -> DataFrame:
    """(part_col, files, bytes, wanted): the partitions with several files below half the target size that
    would fit in fewer files of the target size. Reads the files' sizes, no data columns."""
    files = spark.read.parquet(path).select(part_col, "_metadata.file_path", "_metadata.file_size").distinct()
    parts = files.groupBy(part_col).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"),
        F.count_if(F.col("file_size") < target_bytes / 2).alias("small"))
    parts = parts.withColumn("wanted", F.ceil(F.col("bytes") / target_bytes).cast("int"))
    return parts.where((F.col("small") > 1) & (F.col("wanted") < F.col("files"))).drop("small")


def compact_small_files(spark: SparkSession, path: str, part_col: str, target_bytes: int = 128 << 20) -> list:
    """SNK7 in place: rewrite only the partitions of small files, each as so many files as its bytes fill; all
    other partitions keep theirs. Returns the rewritten partitions (at most one value per partition)."""
    from pulsevault.session import scratch_path
    picked = small_file_partitions(spark, path, part_col, target_bytes).collect()
    if not picked:
        return []
    values = [r[part_col] for r in picked]
    rows = read_days(spark.read.parquet(path), values, part_col)
    kept = scratch_path(spark, "compact")
    rows.write.parquet(kept)  # the partitions are replaced by what was read from them
    wanted = max(r["wanted"] for r in picked)
    rows = spark.read.schema(rows.schema).parquet(kept)
    (cluster_by_partition(rows, part_col, wanted).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))
    return values


def file_count(spark: SparkSession, path: str) -> int:
    """Number of data files behind a path (driver-side listing metadata only)."""
    return len(spark.read.parquet(path).inputFiles())
