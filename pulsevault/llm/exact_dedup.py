"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Three narrow passes, each over fewer candidates: (1) rows per byte length; (2) rows per (length, prefix
hash) among the lengths that occur twice; (3) a full SHA-256 for the rows whose (length, prefix) occurs
twice. Texts never enter a shuffle, only (id, length, hash) do, so a group of copies of any size costs
one partial-aggregate row per task. What a pass leaves goes to the next one as a bitmap of ``FILTER_BITS`` bits
over key hashes, broadcast whatever the number of keys: two keys with one bit only make the next pass look at a
few rows more, and the full hash decides.

Defined results: a null text equals the empty text; the empty text is a text like any other; of equal
texts the row with the largest id stays, a null id counting as the smallest; rows that repeat both id
and text are one group in which one row stays; an empty table gives an empty table; other columns are
never read here, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import small_or, stored, text_of, unused

PREFIX_CHARS = 128
#: Bits of a pass's bitmap (32 MB), dealt over blocks of ``_BLOCK_BITS`` bits. Only blocks with keys are sent.
FILTER_BITS, _BLOCK_BITS = 1 << 28, 1 << 15
#: Dropped rows that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def _place(*keys: Column) -> tuple[Column, Column]:
    """Block and bit of a key."""
    at = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    return F.floor(at / _BLOCK_BITS).cast("int"), at % _BLOCK_BITS


def _bitmap(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Stored (__block, __bits) over the keys that occur twice or more."""
    twice = rows.groupBy(*keys).count().filter("count > 1")
    block, bit = _place(*[F.col(k) for k in keys])
    return stored(twice.groupBy(block.alias("__block")).agg(F.bitmap_construct_agg(bit).alias("__bits")), name)


def _marked(rows: DataFrame, bitmap: DataFrame, keys: list[Column], flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether the keys may be in the bitmap."""
    block, bit = _place(*keys)
    small = F.broadcast(bitmap)
    byte = F.conv(F.hex(F.substring(small["__bits"], (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.join(small, block == small["__block"], "left").select(rows["*"], F.coalesce(is_set, F.lit(False)).alias(flag))


def _keys(text: Column) -> tuple[Column, Column]:
    return F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS))


class Candidates:
    """The texts that two passes leave: by length, then by length and prefix hash."""

    def __init__(self, docs: DataFrame, text_col: str):
        n_bytes, prefix = _keys(text_of(docs, text_col))
        self.lengths = _bitmap(docs.select(n_bytes.alias("n_bytes")), ["n_bytes"], "dedup-lengths")
        second = _marked(docs.select(n_bytes.alias("n_bytes"), prefix.alias("prefix")), self.lengths, [F.col("n_bytes")], "__same")
        second = second.filter("__same").select("n_bytes", "prefix")
        self.prefixes = _bitmap(second, ["n_bytes", "prefix"], "dedup-prefixes")

    def digested(self, rows: DataFrame, text: str, name: str) -> DataFrame:
        """``rows`` with a column ``name``: the hex SHA-256 of the column ``text`` where both passes leave it, else null."""
        length, same, both = (unused(rows, c) for c in ("__length", "__same_length", "__same_prefix"))
        n_bytes, prefix = _keys(text_of(rows, text))
        rows_ = _marked(rows.withColumn(length, n_bytes), self.lengths, [F.col(length)], same)
        rows_ = rows_.withColumn(both, F.when(F.col(same), prefix))
        flag = unused(rows_, "__candidate")
        rows_ = _marked(rows_, self.prefixes, [F.col(length), F.col(both)], flag)
        sha = F.when(F.col(same) & F.col(flag), F.sha2(text_of(rows, text), 256))
        return rows_.withColumn(name, sha).drop(length, same, both, flag)


def hashed_rows(docs: DataFrame, id_col: str, text_col: str, digest_all: bool, candidates: Candidates) -> DataFrame:
    """(doc_id, sha, candidate) per row; ``sha`` (hex SHA-256) is null for rows that an earlier pass proved unique,
    unless ``digest_all``."""
    base = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    rows = candidates.digested(base, "t", "sha").withColumn("candidate", F.col("sha").isNotNull())
    sha = F.coalesce("sha", F.sha2(F.col("t"), 256)) if digest_all else F.col("sha")
    return stored(rows.select("doc_id", sha.alias("sha"), "candidate"), "dedup-hashes")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False,
                 candidates: Candidates | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    hashes = hashed_rows(docs, id_col, text_col, digest_all, candidates or Candidates(docs, text_col))
    rows = stored(hashes.groupBy("doc_id", "sha", "candidate").agg(F.count(F.lit(1)).alias("n")), "dedup-rows")
    groups = rows.filter("candidate").groupBy("sha").agg(F.max("doc_id").alias("keep"), F.sum("n").alias("size"))
    groups = stored(groups.filter("size > 1"), "dedup-groups")
    out = rows.join(groups, "sha", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    grouped = F.col("size").isNotNull()
    keep = F.when(grouped, F.col("keep")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (~grouped | keep.eqNullSafe(F.col("doc_id")) & (F.col("copy") == 1)).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    candidates, own = Candidates(docs, text_col), unused(docs, "__own_sha")
    groups = stored(exact_groups(docs, id_col, text_col, candidates=candidates).filter("group_size > 1"), "dedup-decisions")
    gone = groups.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    gone = stored(gone.filter("not stays or n > 1").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("stays").alias("__stays")), "dedup-gone")
    # texts that the passes prove unique are not hashed here either: a null digest is no row's
    rows = candidates.digested(docs, text_col, own)
    match = lambda right: rows[id_col].eqNullSafe(right["__id"]) & (rows[own] == right["__sha"])
    _, marked = small_or(gone, BROADCAST_KEYS)
    kept = rows.join(marked, match(marked), "left_anti").drop(own)
    repeated = gone.filter("__stays")
    if repeated.isEmpty():
        return kept
    _, repeated = small_or(repeated, BROADCAST_KEYS)
    one = rows.join(repeated, match(repeated), "left_semi").dropDuplicates([id_col, own])
    return kept.unionByName(one.drop(own))


#: DuckDB twin of ``op9_exact_dedup``.
SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id
         AND row_number() OVER (PARTITION BY d.text_sha256, d.doc_id) = 1 AS kept,
       d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
