"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Each source is a queue of its documents in a shuffled order (MD5 of a seed and the id), queued up to
``max_repeats`` times over. A document's virtual finish time is the words its source has queued up to
and including it, divided by the source's target. The mix is the global order of the finish times, cut
where the words reach the budget.

Prefix sums are two-level: words per (source, bucket of the shuffle order) are summed first, a window
over those few sums gives each bucket's offset, and the documents are cumulated within a bucket only, so
a source that holds a third of the rows is spread over all buckets. The global cut works alike: words
per bucket of finish time, then the order inside the one bucket that holds the cut. The number of
buckets follows the number of rows and does not affect the result.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a null id
counts as the text 'null' in the shuffle; ties in the shuffle go by id, then by the text's MD5; repeated rows are
queued each; a document of size 0 takes 0 words; an empty table gives an empty table. The source totals
(one row per source) are ranked in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.llm.common import small_or, stored, text_of, unused, words_in

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
#: Rows that one bucket of a prefix sum should hold, about.
BUCKET_ROWS = 4_000
#: Sources whose totals are broadcast at most.
BROADCAST_SOURCES = 100_000


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS, share: float = 1.0) -> DataFrame:
    """(source, source_size, target): weights are dealt to the sources in code point order, null last, and
    repeat; a target above ``max_repeats`` times its source's size stops there and the rest is reshared.

    With the sources ordered by cap per weight, a source is capped exactly if its cap is below its share
    of what the sources before it leave, so one pass over the ordered sources finds the final level: that
    of the first uncapped source, the highest of the uncapped ones."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    k = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = reduce(lambda c, i: c.when(k == i, float(weights[i])), range(1, len(weights)), F.when(k == 0, float(weights[0])))
    cap = F.col("source_size").cast("double") * max_repeats
    t = totals.withColumn("weight", weight).withColumn("cap", cap).withColumn("order", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("order", F.col("source").asc_nulls_last())
    before, onward = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumn("budget", F.sum("source_size").over(everything).cast("double") * share)
    t = t.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    t = t.withColumn("final", F.max(F.when(F.col("order") >= F.col("level"), F.col("level"))).over(everything))
    share_of = F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))
    return t.select("source", "source_size", F.least("cap", share_of).alias("target"))


def _hex_digits(rows: int) -> int:
    digits = 1
    while 16 ** digits * BUCKET_ROWS < rows and digits < 7:
        digits += 1
    return digits


def queue(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple, max_repeats: int, seed: str) -> DataFrame:
    """Stored rows (doc_id, source, size, key, tie, source_size, target, upto): ``upto`` counts the words of
    the source's queue up to and including the document."""
    text = text_of(docs, text_col)
    key = F.md5(F.concat(F.lit(seed), F.lit("|"), F.coalesce(docs[id_col].cast("string"), F.lit("null"))).cast("binary"))
    sized = stored(docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), words_in(text).alias("size"),
        key.alias("key"), F.md5(text.cast("binary")).alias("tie")), "mix-sizes")
    digits = _hex_digits(sized.count())
    targets = stored(source_targets(sized, weights, max_repeats), "mix-targets")
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sums.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"),
                                 F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")), "mix-offsets")
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = sized.withColumn("within", F.sum("size").over(inside))
    rows = rows.join(offsets, rows["source"].eqNullSafe(offsets["o_source"]) & (rows["bucket"] == offsets["o_bucket"]))
    _, targets = small_or(targets.withColumnRenamed("source", "t_source"), BROADCAST_SOURCES)
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["t_source"]))
    return stored(rows.select("doc_id", "source", "size", "key", "tie", "source_size", "target",
                              (F.col("offset") + F.col("within")).alias("upto")), "mix-queue")


def _finish(repeat: Column) -> Column:
    """Virtual finish time of a document's ``repeat``-th copy (from 0)."""
    words = repeat.cast("long") * F.col("source_size") + F.col("upto")
    return F.when(F.col("target") > 0, words.cast("double") / F.col("target")).otherwise(F.lit(0.0))


def _rank(finish: Column, repeat: Column) -> Column:
    null_last = F.when(F.col("source").isNull(), 1).otherwise(0)
    return F.struct(finish.alias("finish"), null_last.alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
                    F.col("key"), F.col("tie"), repeat.cast("int").alias("repeat"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, copies, source, tie."""
    rows = queue(docs, id_col, text_col, source_col, weights, max_repeats, seed)
    n = rows.count()
    budget = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1024, max_repeats * n // BUCKET_ROWS)
    repeats = F.explode(F.array(*[F.lit(i) for i in range(max_repeats)])).alias("repeat")
    copies = rows.select("*", repeats).withColumn("finish", _finish(F.col("repeat")))
    copies = copies.withColumn("at", F.least(F.floor(F.col("finish") * buckets), F.lit(4 * buckets)))
    upto = Window.orderBy("at")
    per_bucket = copies.groupBy("at").agg(F.sum("size").alias("words")).withColumn("total", F.sum("words").over(upto))
    cut = per_bucket.filter(F.col("total") > budget).orderBy("at").select("at", (F.lit(budget) - F.col("total") + F.col("words")).alias("left")).first()
    taken = lambda repeat: F.lit(True)
    if cut is not None:
        inside = copies.filter(F.col("at") == cut["at"]).withColumn("rank", _rank(F.col("finish"), F.col("repeat")))
        running = F.sum("size").over(Window.orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        last = inside.withColumn("running", running).filter(F.col("running") <= cut["left"]).agg(F.max("rank").alias("rank"))
        at = lambda repeat: F.least(F.floor(_finish(repeat) * buckets), F.lit(4 * buckets))
        end = last.first()["rank"]
        if end is None:
            taken = lambda repeat: at(repeat) < cut["at"]
        else:
            edge = F.struct(*[F.lit(v).cast(t).alias(k) for (k, v), t in zip(
                end.asDict().items(), ("double", "int", "string", "string", "string", "int"), strict=True)])
            taken = lambda repeat: (at(repeat) < cut["at"]) | ((at(repeat) == cut["at"]) & (_rank(_finish(repeat), repeat) <= edge))
    count = reduce(lambda a, b: a + b, [F.when(taken(F.lit(i)), 1).otherwise(0) for i in range(max_repeats)])
    rows = rows.withColumn("copies", count)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", "tie")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **params) -> DataFrame:
    """The mix itself: the rows of ``docs`` with their columns, each as often as the mix takes it."""
    decided = mix(docs, id_col, text_col, source_col, **params)
    id_, source, tie, copies, n, own, copy = (unused(docs, f"__mix_{k}") for k in ("id", "source", "tie", "copies", "rows", "text", "copy"))
    decided = stored(decided.groupBy(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("tie").alias(tie))
                     .agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(n)), "mix-decisions")
    rows = docs.withColumn(own, F.md5(text_of(docs, text_col).cast("binary")))
    if not decided.filter(F.col(n) > 1).isEmpty():  # one of a set of repeated rows stands for all
        rows = rows.dropDuplicates([id_col, source_col, own])
    decided = decided.filter(F.col(copies) > 0)
    same = (rows[id_col].eqNullSafe(decided[id_]) & rows[source_col].cast("string").eqNullSafe(decided[source])
            & (rows[own] == decided[tie]))
    rows = rows.join(decided, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return rows.drop(id_, source, tie, copies, n, own, copy)


#: DuckDB twin of ``op8_mixing``.
SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
             source_size::DOUBLE * 3 AS cap, sum(source_size) OVER ()::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, max(CASE WHEN cap / weight >= level THEN level END) OVER () AS final FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(final * weight, cap)) AS target, budget FROM f),
q AS (SELECT d.*, t.source_size, t.target, t.budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, tie ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, r.n, CASE WHEN target > 0 THEN (r.n * source_size + upto)::DOUBLE / target ELSE 0 END AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS n) r),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, k, tie, n, doc_id ROWS UNBOUNDED PRECEDING) AS running FROM c)
SELECT doc_id, size, source_size, target,
       sum(CASE WHEN running <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM g GROUP BY doc_id, size, source_size, target, source, k, tie
"""
