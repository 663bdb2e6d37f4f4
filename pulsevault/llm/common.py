"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsevault.session import scratch_path, ship_package

#: One word: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder once (with these writer options) and read it
    back, so that a lost executor costs the tasks that it held and not everything upstream."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch that goes to a Python worker, at most.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def executors_ready(spark: SparkSession) -> None:
    """Ship this package to the Python workers (they run the operators' per-batch functions), and bound the
    batches that they are sent by bytes; texts differ in length by orders of magnitude."""
    ship_package(spark)
    now = spark.conf.get(_BATCH_CONF).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def small_or(df: DataFrame, max_rows: int) -> tuple[bool, DataFrame]:
    """Whether ``df`` (stored) has at most ``max_rows`` rows, and ``df`` marked for broadcast if it has."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return small, F.broadcast(df) if small else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until it is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def words_in(text: Column) -> Column:
    """How many words ``text`` holds (long)."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


#: Bytes of text that a task works on at a time, about.
CHUNK_BYTES = 1 << 20


def text_chunks(batches, column: int, limit: int = CHUNK_BYTES):
    """Slices of Arrow batches with the UTF-8 bytes of their texts, of about ``limit`` bytes (one text at
    least), so that a task's working memory follows the longest text and not the batch."""
    for b in batches:
        start, held, texts = 0, 0, []
        for i, value in enumerate(b.column(column)):
            texts.append(value.as_buffer().to_pybytes() if value.is_valid else b"")
            held += len(texts[-1])
            if held >= limit:
                yield b.slice(start, i + 1 - start), texts
                start, held, texts = i + 1, 0, []
        if texts:
            yield b.slice(start, len(texts)), texts
    pa.default_memory_pool().release_unused()
