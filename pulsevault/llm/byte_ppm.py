"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER``, kept as counts of (context, next byte). A byte is
coded in the longest context that was seen; if it never followed that context, an escape is coded and the
next shorter context takes over, without the bytes that the longer one would have coded (symbol
exclusion). Escapes are estimated by method D: a byte with count c has probability (2c - 1) / 2n and the
escape q / 2n, where n is the sum of counts and q the number of bytes, exclusions left out. Shorter contexts
learn with update exclusion: a byte counts once per longer context that it was new in. Below order 0 all
bytes not yet excluded are alike. A text is coded with a start mark before and an end mark after it.

Counting: every task adds up its own distinct (context, byte) pairs, one row each, and Spark sums them.
All contexts that share their last three bytes meet in one task (the pairs there are at most 256 to the
power of ``ORDER`` - 2, whatever the corpus), where each pair, seen or only asked for, gets its log
probability, some contexts at a time; orders 0 to 2 (at most 256^3 pairs) are broadcast.

Scoring: a text's score is the sum over its positions. The corpus is divided into blocks (stretches of rows
of an input file; rows from elsewhere are dealt by hash). The distinct pairs and tokens of every block are joined with their
log probabilities and counts, sent back to the block, and looked up there while the block's texts stream
by. No task holds more than one block's distinct pairs (16 bytes each), and nothing is broadcast that grows.

The base score is the unigram score of the text's tokens with counts smoothed by 0.1.

Defined results: a null text equals the empty text, which is one end token; A-Z are lower-cased; a null
id counts as the empty text when folds are dealt; repeated rows are counted and scored each; with no
training text every byte has probability 1/256; an empty table gives an empty table; only the id and
the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import crc_mod, executors_ready, stored, text_chunks, text_of
from pulsevault.llm.words import word_hashes

#: Bytes of context; (context, byte) pairs fit in 64 bits up to 7.
ORDER = 5
FOLDS, HELD_OUT = 10, 0
#: Bytes of text that make one block, about.
BLOCK_BYTES = 48 << 20
#: Byte that marks starts and ends (never part of UTF-8).
MARK = 0xFF
#: Pairs of whole contexts that a task works on at a time, at least.
GROUP_PAIRS = 1 << 20
SMOOTH = 0.1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END_TOKEN = np.uint64(0x5BD1E995A2C79F13)
_SHARED = 3
#: The keys of a block come sorted; stored as differences they take half the space.
_DELTAS = {"parquet.writer.version": "v2"}


def _mask(order: int) -> np.uint64:
    """Keeps the last ``order`` + 1 bytes of a packed pair."""
    return np.uint64((1 << (8 * (order + 1))) - 1)


def packed(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, per text) of the texts with their marks: every position's context and byte in one number,
    the byte lowest, and where each text's positions start (one entry more: the end)."""
    gap = bytes([MARK]) * order
    data = _LOWER[np.frombuffer(gap + b"".join(t + bytes([MARK]) + gap for t in texts), np.uint8)]
    pairs = np.zeros(len(data) - order, np.uint64)
    for i in range(order + 1):
        pairs <<= np.uint64(8)
        pairs |= data[i:i + len(pairs)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    own = np.cumsum(sizes + order) - sizes - order
    keep = np.ones(len(pairs), bool)
    ends = own + sizes
    for i in range(order):
        at = ends + i
        keep[at[at < len(pairs)]] = False
    return pairs[keep], np.concatenate(([0], np.cumsum(sizes)))


def text_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, per text): the words of each text, then its end."""
    joined = b"\n".join(texts) + b"\n"
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    hashes, at = word_hashes(np.frombuffer(joined, np.uint8), lower=True)
    edges = np.searchsorted(at, bounds)
    return np.insert(hashes, edges[1:], _END_TOKEN), edges + np.arange(len(edges))


class Trie:
    """Counts of one order and what the order above needs from them: sorted pairs with counts, and per
    context the sum of counts and the number of bytes, with and without the bytes of its own extension."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        self.pairs, self.counts = pairs, counts
        context = pairs >> np.uint64(8)
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(pairs) else np.zeros(0, np.int64)
        self.contexts = context[first]
        self.first = first
        self.n = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        self.q = np.diff(np.append(first, len(pairs)))
        self.rest_n = self.rest_q = None

    def shorter(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and counts of contexts shorter by one (``order`` is the shorter). A pair counts once for each
        longer context that it was new in, as it does when only the contexts that fail to predict a byte
        learn it (update exclusion)."""
        pairs, times = np.unique(self.pairs & _mask(order), return_counts=True)
        return pairs, times.astype(np.int64)

    def exclude_from(self, below: "Trie", order: int) -> None:
        """What is left of the shorter context (``below``, of ``order``) without this context's bytes."""
        if not len(self.contexts):
            self.rest_n = self.rest_q = np.zeros(0, np.int64)
            return
        parent = np.searchsorted(below.contexts, self.contexts & (_mask(order) >> np.uint64(8)))
        gone = below.counts[np.searchsorted(below.pairs, self.pairs & _mask(order))]
        self.rest_n = below.n[parent] - np.add.reduceat(gone, self.first)
        self.rest_q = below.q[parent] - self.q


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.searchsorted(table, keys)
    hit = i < len(table)
    hit[hit] = table[i[hit]] == keys[hit]
    return i, hit


def ladder(pairs: np.ndarray, counts: np.ndarray, order: int, down_to: int, low: list["Trie"] | None = None) -> list[Trie]:
    """Tries of orders 0 to ``order`` (those below ``down_to`` are taken from ``low``)."""
    out: list = [None] * (order + 1)
    out[order] = Trie(pairs, counts)
    for k in range(order - 1, down_to - 1, -1):
        out[k] = Trie(*out[k + 1].shorter(k))
    for k in range(down_to):
        out[k] = low[k]
    for k in range(order, max(down_to, 1) - 1, -1):
        out[k].exclude_from(out[k - 1], k - 1)
    return out


def log_probabilities(tries: list[Trie], asked: np.ndarray) -> np.ndarray:
    """Natural log probability of each asked (context, byte) pair of the highest order."""
    out = np.zeros(len(asked))
    open_ = np.ones(len(asked), bool)
    n = np.full(len(asked), -1, np.int64)  # of the context in turn, exclusions left out; -1: no longer one was seen
    q = np.zeros(len(asked), np.int64)
    for k in range(len(tries) - 1, -1, -1):
        t = tries[k]
        node, seen = _found(t.contexts, (asked & _mask(k)) >> np.uint64(8))
        fresh = seen & (n < 0)
        n[fresh], q[fresh] = t.n[node[fresh]], t.q[node[fresh]]
        at, has = _found(t.pairs, asked & _mask(k))
        now = open_ & has & (n > 0)
        out[now] += np.log((2 * t.counts[at[now]] - 1) / (2 * n[now]))
        open_ &= ~now
        escape = open_ & seen & (n > 0)
        out[escape] += np.log(q[escape] / (2 * n[escape]))
        if k:
            on = open_ & seen
            n[on], q[on] = t.rest_n[node[on]], t.rest_q[node[on]]
    unseen = 256 - (tries[0].q[0] if len(tries[0].q) else 0)
    out[open_] -= np.log(max(unseen, 1))
    return out


class Lookup:
    """Values of a fixed set of 64-bit keys, as two flat arrays (16 bytes a key) in the order of the keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys = keys[order]
        del keys
        self.values = values[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Asked in the order of the keys, each once, so that the search walks through memory one way."""
        asked, back = np.unique(keys, return_inverse=True)
        at, hit = _found(self.keys, asked)
        if not hit.all():
            raise RuntimeError("a text holds a key that its block did not count: the input changed between two reads")
        return self.values[at][back]


def _table(parts: list) -> Lookup:
    """The lookup of (keys, values) parts, which are let go as it is made."""
    keys = np.concatenate([k for k, _ in parts])
    parts[:] = [v for _, v in parts]
    values = np.concatenate(parts)
    parts.clear()
    return Lookup(keys, values)


def in_blocks(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` of ``docs`` (with a column t) and the block that each is in, which follows from the row alone, as
    often as it is read: about ``BLOCK_BYTES`` of text make a block. Rows of Parquet files are in blocks of so
    many rows of a file; others are dealt by hash, stored once block by block."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t")).alias("b")).first()
    n, size = total["n"], total["b"] or 0
    try:
        place = docs.select(docs["_metadata.file_path"], docs["_metadata.row_index"]).limit(0) is not None
    except AnalysisException:  # not a scan of Parquet files
        place = False
    if place:
        per_block = max(1, n * BLOCK_BYTES // max(size, 1))
        return rows.withColumn("block", F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / per_block)))
    blocks = -(-max(size, 1) // BLOCK_BYTES)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "t"), F.lit(blocks)))
    return stored(dealt.repartition(blocks, "block").sortWithinPartitions("block"), "ppm-rows")


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights, first)


class _Counts:
    """Occurrences of keys: what came lately is summed up when it is half as much as what is summed already."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.late: list = []

    def add(self, keys: np.ndarray, count: bool) -> None:
        keys, n = np.unique(keys, return_counts=True)
        self.late.append((keys, n.astype(np.int64) if count else np.zeros(len(keys), np.int64)))
        if sum(len(k) for k, _ in self.late) > max(len(self.keys) // 2, 1 << 19):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        late, self.late = self.late, []
        if late:
            keys = np.concatenate([self.keys, *(k for k, _ in late)])
            n = np.concatenate([self.n, *(c for _, c in late)])
            self.keys = self.n = late = None
            self.keys, self.n = _summed(keys, n)
        return self.keys, self.n


def block_counts(rows: DataFrame, order: int) -> DataFrame:
    """(block, kind, key, n) of the distinct pairs (kind 0) and tokens (kind 1) of each block; ``rows``: (block,
    train, t). n: occurrences in training texts, 0 for keys that only other texts hold."""

    def run(batches):
        held, block = {}, None

        def done():
            for kind, counts in held.items():
                keys, n = counts.all()
                for i in range(0, len(keys), 1 << 16):
                    k = keys[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), block, np.int64)), pa.array(np.full(len(k), kind, np.int32)),
                         pa.array(k.astype(np.int64)), pa.array(n[i:i + (1 << 16)])], names=["block", "kind", "key", "n"])

        for b, texts in text_chunks(batches, 2):
            blocks, train = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for mine in dict.fromkeys(blocks.tolist()):
                if mine != block:
                    yield from done()
                    held, block = {0: _Counts(), 1: _Counts()}, mine
                for use in (True, False):
                    some = [t for t, x, y in zip(texts, blocks, train, strict=True) if x == mine and y == use]
                    if some:
                        held[0].add(packed(some, order)[0], use)
                        held[1].add(text_tokens(some)[0], use)
        yield from done()

    return rows.mapInArrow(run, "block long, kind int, key long, n long")


def pair_log_probabilities(pairs: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 probability of every pair of ``pairs`` (key, n); pairs with n > 0 are the model."""
    low_order = _SHARED - 1
    longer = pairs.filter("n > 0").select(F.col("key").bitwiseAND(F.lit(int(_mask(_SHARED)))).alias("pair")).distinct()
    low = longer.groupBy(F.col("pair").bitwiseAND(F.lit(int(_mask(low_order)))).alias("pair")).agg(F.count(F.lit(1)).alias("n"))
    low = low.orderBy("pair").toPandas()
    base = ladder(low.pair.to_numpy(np.int64).astype(np.uint64), low.n.to_numpy(np.int64), low_order, 0)

    def run(batches):
        keys, n, held = [], [], 0
        for b in batches:
            k, c = b.column(0).to_numpy().astype(np.uint64), b.column(1).to_numpy()
            if held >= GROUP_PAIRS:  # whole contexts only: up to where the last one of this batch starts
                mine = (k >> np.uint64(8)) & _mask(_SHARED - 1)
                cut = int(np.argmax(mine != shared_of(keys[-1][-1]))) if len(k) and (mine != shared_of(keys[-1][-1])).any() else len(k)
                keys.append(k[:cut])
                n.append(c[:cut])
                if cut < len(k):
                    yield from valued(np.concatenate(keys), np.concatenate(n))
                    keys, n, held = [k[cut:]], [c[cut:]], len(k) - cut
                continue
            keys.append(k)
            n.append(c)
            held += len(k)
        if keys:
            yield from valued(np.concatenate(keys), np.concatenate(n))

    def shared_of(key):
        return (key >> np.uint64(8)) & _mask(_SHARED - 1)

    def valued(keys, n):
        order_ = np.argsort(keys)
        keys, n = keys[order_], n[order_]
        tries = ladder(keys[n > 0], n[n > 0], order, _SHARED, base)
        value = log_probabilities(tries, keys) / np.log(10)
        for i in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 16)].astype(np.int64)), pa.array(value[i:i + (1 << 16)])], names=["key", "value"])

    shared = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * _SHARED)) - 1))
    dealt = pairs.select("key", "n").repartition(shared).sortWithinPartitions(shared)
    return dealt.mapInArrow(run, "key long, value double")


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, folds: int = FOLDS,
           held_out: int = HELD_OUT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    executors_ready(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    rows = in_blocks(rows, docs).select("block", (crc_mod(F.col("doc_id"), folds) != held_out).alias("train"), "doc_id", "t")
    counts = stored(block_counts(rows.select("block", "train", "t"), order), "ppm-block-counts", **_DELTAS)
    total = lambda kind: counts.filter(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n"))
    pairs, tokens = stored(total(0), "ppm-pairs"), stored(total(1), "ppm-tokens")
    sums = tokens.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    n_train, v_train = int(sums["n"] or 0), int(sums["v"] or 0)
    values = pair_log_probabilities(pairs, order).select(F.lit(0).alias("kind"), "key", "value")
    values = values.unionByName(tokens.select(F.lit(1).alias("kind"), "key", F.col("n").cast("double").alias("value")))
    lookups = counts.select("block", "kind", "key").join(stored(values, "ppm-values"), ["kind", "key"])
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    doc = f"struct<doc_id:{id_kind},t:string,train:boolean>"
    # one number for block and kind: these rows are the bulk of what is shuffled
    slot = lambda kind: F.shiftleft("block", 2).bitwiseOR(kind.cast("long")).alias("slot")
    every = lookups.select(slot(F.col("kind")), "key", "value", F.lit(None).cast(doc).alias("doc"))
    every = every.unionByName(rows.select(slot(F.lit(2)), F.lit(0).cast("long").alias("key"), F.lit(0.0).alias("value"),
                                          F.struct("doc_id", "t", "train").cast(doc).alias("doc")))
    every = every.repartition(F.shiftright("slot", 2)).sortWithinPartitions("slot")
    floor = n_train + SMOOTH * (v_train + 1)

    def run(batches):
        block, tables, parts = None, None, {0: [], 1: []}
        for batch in batches:
            slots = batch.column(0).to_numpy()
            blocks, kinds = slots >> 2, slots & 3
            cuts = np.flatnonzero(np.diff(slots) != 0) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)], strict=True):
                if z == a:
                    continue
                if blocks[a] != block:
                    block, tables, parts = blocks[a], None, {0: [], 1: []}
                part, kind = batch.slice(a, z - a), int(kinds[a])
                if kind < 2:
                    if kind and tables is None:
                        tables, parts[0] = [_table(parts[0])], []
                    parts[kind].append((part.column(1).to_numpy(zero_copy_only=False).astype(np.int64).astype(np.uint64),
                                        part.column(2).to_numpy(zero_copy_only=False).astype(float)))
                    continue
                if len(tables) < 2:
                    tables, parts[1] = [*tables, _table(parts[1])], []
                yield from scores(pa.RecordBatch.from_arrays(part.column(3).flatten(), names=["doc_id", "t", "train"]), tables)

    def scores(part, tables):
        for b, texts in text_chunks([part], 1):
            pairs_, edges = packed(texts, order)
            score = np.add.reduceat(tables[0](pairs_), edges[:-1])
            tokens_, edges = text_tokens(texts)
            count = tables[1](tokens_)
            base = np.add.reduceat(np.log10((count + SMOOTH) / floor), edges[:-1])
            known = np.add.reduceat((count > 0).astype(np.int64), edges[:-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(~b.column(2).to_numpy(zero_copy_only=False).astype(bool)), pa.array(np.diff(edges)), pa.array(known),
                 pa.array(np.full(len(texts), n_train, np.int64)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return every.mapInArrow(run, f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double")
