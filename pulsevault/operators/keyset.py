"""Keys ever loaded, for exact keyed inserts of re-delivered rows (DV1, DV3).

A key set is two tables under one root:

* ``keys``: every key once, in directories by key hash (``bucket``);
* ``filter``: Bloom filters over them, one row per block of ``BLOCK_BITS`` bits. A key belongs to one block
  and sets ``PROBES`` bits there, so a block is an ordinary ``bitmap_construct_agg`` and blocks of two loads
  merge by ``bitmap_or_agg``. A filter takes about 1.5 bytes a key.

``unseen`` meets a batch with what is stored in three steps of growing cost: the rows that the caller holds
near (the stored rows of the batch's own days, where nearly every second delivery is), then the filter (the
batch's keys are shuffled to it, the stored keys are not read), then, for the keys that pass the filter,
the directories that these keys fall in. New keys pass the filter with a probability below 1 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsevault.session import scratch_path
from pulsevault.sources import sinks as SK

BLOCK_BITS, PROBES = 32768, 7
#: A filter is made anew, with twice the blocks it needs, when its blocks hold more keys than this on average.
KEYS_PER_BLOCK = 2700


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def _block(key: Column, blocks) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def key_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, n, bits) over the column ``key``: how many keys each block holds, and their bits. The keys are dealt by
    block first: otherwise every task would make bitmaps of all blocks, and their number is tasks times blocks."""
    dealt = keys.select(_block(F.col("key"), F.lit(blocks)).alias("block"), "key").repartition("block")
    rows = dealt.select("block", F.posexplode(F.array(*_bits(F.col("key")))).alias("at", "bit"))
    return rows.groupBy("block").agg(F.count_if(F.col("at") == 0).alias("n"), F.bitmap_construct_agg("bit").alias("bits"))


def merged_filter(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("block").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def passing(keys: DataFrame, blocks: int, key_filter_: DataFrame) -> DataFrame:
    """The keys that the filter may hold: all that it holds, and few others."""
    hit = keys.withColumn("block", _block(F.col("key"), F.lit(blocks))).join(key_filter_.select("block", "bits"), "block")
    for bit in _bits(F.col("key")):
        hit = hit.where(_is_set(F.col("bits"), bit))
    return hit.drop("block", "bits")


class KeySet:
    """The keys stored under ``root``, in ``buckets`` directories."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucketed(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit("bucket")), F.lit(self.buckets)).cast("int"))

    def _filter(self) -> tuple[int, DataFrame] | None:
        path = f"{self.root}/filter"
        if not SK.list_snapshots(self.spark, path):
            return None
        rows = SK.read_snapshot(self.spark, path)
        first = rows.select("blocks").first()
        return None if first is None else (first["blocks"], rows.drop("blocks"))

    def stored(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The stored keys, of some directories if given."""
        rows = SK.read_if_exists(self.spark, f"{self.root}/keys")
        return rows if rows is None or buckets is None else rows.where(F.col("bucket").isin(buckets))

    def known(self, keys: DataFrame) -> DataFrame | None:
        """Those of the distinct ``keys`` (column key) that are stored; None if none can be."""
        found = self._filter()
        if found is None:
            return None
        path = scratch_path(self.spark, "keys-suspected")
        self._bucketed(passing(keys, *found)).write.parquet(path)
        suspects = self.spark.read.parquet(path)
        touched = sorted(r["bucket"] for r in suspects.select("bucket").distinct().collect())  # directory numbers
        if not touched:
            return None
        return suspects.select("key").join(self.stored(touched).select("key"), "key").distinct()

    def unseen(self, rows: DataFrame, key: str, near: DataFrame | None = None) -> DataFrame:
        """The rows whose key is not stored; ``near``: stored rows that are looked at first (column ``key``)."""
        if near is not None:
            rows = rows.join(near.select(key), key, "left_anti")
        known = self.known(rows.select(F.col(key).alias("key")).distinct())
        return rows if known is None else rows.join(known.withColumnRenamed("key", key), key, "left_anti").select(*rows.columns)

    def add(self, keys: DataFrame) -> None:
        """Store new distinct keys (column key) and set their bits."""
        keys.transform(self._bucketed).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.root}/keys")
        found, n = self._filter(), keys.count()
        if found is not None:
            blocks, old = found
            n += old.agg(F.sum("n")).first()[0] or 0
        if found is None or n > blocks * KEYS_PER_BLOCK:
            blocks = max(1, -(-2 * n // KEYS_PER_BLOCK))
            rows = key_filter(self.stored().select("key") if n else keys, blocks)
        else:
            rows = merged_filter(old, key_filter(keys, blocks))
        SK.write_snapshot(self.spark, rows.withColumn("blocks", F.lit(blocks)), f"{self.root}/filter")
