"""Session helpers: a local builder for tests/bench and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # skip per-call Python call-site capture (a py4j round trip per Column function)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Suggested settings for a large cluster (~100 TB of readings). Not applied automatically: a
# cluster job gets its configuration from the platform; ``apply_cluster_conf`` sets only keys the
# session leaves unset.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",      # post-shuffle partition target
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",                           # ~5 GB per reducer before AQE
    "spark.sql.files.maxPartitionBytes": "256m",                       # scan split size
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",                     # runtime-measured sizes only
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",         # prune big sides of selective joins
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set the suggested cluster settings that the session has not set itself (runtime-settable keys)."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        try:
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 — static configs cannot change at runtime
            pass


#: Streaming state on the executors' disks behind a cache of fixed size. The default store keeps all keys on the heap
#: and copies their map in every micro-batch, so its cost is micro-batches times keys.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state as ``STATE_CONF`` says."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pulsevault",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (a cluster supplies its own session)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("PULSEVAULT_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared ``spark.checkpoint.dir``; set a local one only when unset, and only for a
    local master (tests): a machine-local folder on a cluster would lose data."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pulsevault-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table path under the shared checkpoint folder (never a machine-local temp dir
    on a cluster: the root comes from ``spark.checkpoint.dir``)."""
    root = ensure_checkpoint_dir(spark)
    # getCheckpointDir() appends an application-unique sub-folder; keep tables beside it.
    return f"{root.rstrip('/')}/pulsevault-tables/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pulsevault`` importable in executor Python workers (needed by the pandas state
    processor): zip the package once per application and ``addPyFile`` it; Spark distributes
    it to every executor, so nothing has to be pre-installed on the cluster."""
    import shutil

    import pulsevault
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(pulsevault.__file__))
    out_dir = tempfile.mkdtemp(prefix="pulsevault-pyfiles-")  # driver-side artifact; Spark ships it
    archive = shutil.make_archive(os.path.join(out_dir, "pulsevault"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="pulsevault")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
