"""Benchmark decontamination by Wu-Manber multi-pattern search.

An item's windows (its runs of ``WINDOW`` words; all its words, if it has fewer) are the patterns, written as
bytes with one space around every word: `` w1 w2 ... w10 ``. Documents are written the same way, so a pattern
occurs in a document exactly where its words follow each other there.

Patterns are split into classes by length (3, 6, 12, 24, 48, 96 bytes and more). For a class, ``m`` is its
shortest pattern (96 at most). A table holds for every block of bytes how far it ends from the end of any
pattern's first ``m`` bytes; a block that is in no pattern lets the search move on by ``m - block + 1`` bytes.
Where the shift is 0, the hash of the block and of the pattern's first bytes selects the test strings, and all
bytes are compared. A document is searched in many stretches at a time (numpy), all skipping on their own.

Documents stream through once per pattern table and are never shuffled. A table holds ``TABLE_WINDOWS``
windows at most and goes to the tasks; larger benchmarks are taken in blocks of ``BLOCK_BYTES`` of text, one
pass each, and the passes' hits (rows of contaminated documents alone) are merged by (id, text hash).

Defined results: a null or empty text, document or item, has no words and no hits; a null item id is written as
the empty string; items with one id count once; repeated documents get a row each; empty tables give no rows,
or rows without hits; a text of any length is searched whole (a task holds about eight times the longest text);
only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.llm.common import executors_ready, stored, text_chunks, text_of
from pulsevault.llm.words import mixed

#: Words of a window.
WINDOW = 10
#: Bytes of item text that are read at a time, and windows of one table, at most.
BLOCK_BYTES, TABLE_WINDOWS = 4 << 20, 400_000
_CLASSES = (3, 6, 12, 24, 48, 96)
_STRETCH = 256
_PAIRS = 1 << 17
_SPACE, _END = 32, 0
_WRITTEN = np.full(256, _SPACE, np.uint8)
for _kept in (range(48, 58), range(97, 123), range(128, 256)):
    _WRITTEN[list(_kept)] = list(_kept)
_WRITTEN[65:91] = np.arange(97, 123)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def written(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, spaces, ends): every text as a zero byte and its words with one space around each; where the
    spaces are, and where the zero bytes are (one more after the last text). Eight bytes follow as padding."""
    raw = b"\x00\n" + b"\n\x00\n".join(texts) + b"\n\x00" if texts else b"\x00"
    data = _WRITTEN[np.frombuffer(raw, np.uint8)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 3
    data[np.concatenate(([0], np.cumsum(sizes)))] = _END
    gap = data == _SPACE
    gap[1:] &= gap[:-1].copy()
    gap[0] = False
    data = data[~gap]
    spaces, ends = np.flatnonzero(data == _SPACE), np.flatnonzero(data == _END)
    return np.concatenate((data, np.zeros(8, np.uint8))), spaces, ends


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, without a copy."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", buffer=data, strides=(1,))


def _cut(values: np.ndarray, n_bytes) -> np.ndarray:
    """The first ``n_bytes`` (1 to 8) of eight bytes."""
    return values & (_FULL >> (np.uint64(64) - np.uint64(8) * np.asarray(n_bytes, np.uint64)))


class PatternClass:
    """Shift table and suffix-hash buckets of the patterns (``at``, ``size`` in ``pool``) of about one length."""

    def __init__(self, pool: np.ndarray, at: np.ndarray, size: np.ndarray, ids: np.ndarray):
        self.m = int(min(size.min(), _CLASSES[-1]))
        self.block = 16 if self.m >= 32 else min(8, max(2, self.m // 2))
        eights = _eights(pool)
        bits = max(10, min(24, int(4 * min(len(pool), len(at) * self.m)).bit_length()))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.m - self.block + 1, np.uint8)
        for end in range(self.block, self.m + 1):  # later blocks are nearer to the end and stay
            self.shift[self._blocks(eights, at + end - self.block) >> self.down] = self.m - end
        keys = self._keys(eights, at)
        order = np.argsort(keys, kind="stable")
        self.at, self.size, self.ids = at[order], size[order], ids[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))

    def _blocks(self, eights: np.ndarray, start: np.ndarray) -> np.ndarray:
        if self.block == 16:
            return mixed(eights[start] + mixed(eights[start + 8]))
        return mixed(_cut(eights[start], self.block))

    def _keys(self, eights: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of strings that start there: the block that ends their first ``m`` bytes, and their first bytes."""
        return self._blocks(eights, start + self.m - self.block) ^ mixed(_cut(eights[start], min(8, self.m)) * np.uint64(3))

    def candidates(self, eights: np.ndarray, n: int):
        """Starts (some at a time) of the strings in the first ``n`` bytes whose block has shift 0."""
        back = self.block - 1
        pos = np.arange(self.m - 1, n, _STRETCH)
        end = np.minimum(pos + _STRETCH, n)
        found, held = [], 0
        while len(pos):
            step = self.shift[self._blocks(eights, pos - back) >> self.down].astype(np.int64)
            here = pos[step == 0]
            if len(here):
                found.append(here - (self.m - 1))
                held += len(here)
                if held >= _PAIRS:
                    yield np.concatenate(found)
                    found, held = [], 0
            pos = pos + np.maximum(step, 1)
            on = pos < end
            pos, end = pos[on], end[on]
        if found:
            yield np.concatenate(found)

    def occurrences(self, data: np.ndarray, pool: np.ndarray):
        """(start, pattern id) of every occurrence in the written ``data``, some at a time."""
        eights, pooled = _eights(data), _eights(pool)
        n = len(data) - 8
        for start in self.candidates(eights, n):
            keys = self._keys(eights, start)
            bucket = np.searchsorted(self.keys, keys)
            hit = bucket < len(self.keys)
            hit[hit] = self.keys[bucket[hit]] == keys[hit]
            start, bucket = start[hit], bucket[hit]
            many = self.last[bucket] - self.first[bucket]
            before = np.concatenate(([0], np.cumsum(many)))
            for low in range(0, int(before[-1]), _PAIRS):
                pair = np.arange(low, min(low + _PAIRS, int(before[-1])))
                row = np.searchsorted(before, pair, "right") - 1
                yield self._equal(eights, pooled, n, start[row], self.first[bucket[row]] + pair - before[row])

    def _equal(self, eights, pooled, n, start, entry):
        """The pairs whose bytes are all equal."""
        fits = start + self.size[entry] <= n
        start, entry = start[fits], entry[fits]
        done = 0
        while True:
            left = self.size[entry] - done
            more = np.flatnonzero(left > 0)
            if not len(more):
                return start, self.ids[entry]
            n_bytes = np.minimum(left[more], 8)
            wrong = _cut(eights[start[more] + done], n_bytes) != _cut(pooled[self.at[entry[more]] + done], n_bytes)
            keep = np.ones(len(start), bool)
            keep[more[wrong]] = False
            start, entry = start[keep], entry[keep]
            done += 8


class PatternTable:
    """The distinct windows of some items, ready to be searched for."""

    def __init__(self, pool: np.ndarray, at: np.ndarray, size: np.ndarray, words: np.ndarray, owner: np.ndarray, names: list[str]):
        self.pool, self.names = pool, names
        raw, of, distinct = pool.tobytes(), np.empty(len(at), np.int64), {}
        for i, (a, s) in enumerate(zip(at.tolist(), size.tolist(), strict=True)):
            of[i] = distinct.setdefault(raw[a:a + s], len(distinct))
        _, some = np.unique(of, return_index=True)
        at, size, self.words = at[some], size[some], words[some]
        pairs = np.unique(np.stack((of, owner), 1), axis=0)
        self.items = pairs[:, 1]
        self.items_from = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        kind = np.searchsorted(_CLASSES, size, "right")
        self.classes = [PatternClass(pool, at[kind == k], size[kind == k], np.flatnonzero(kind == k)) for k in np.unique(kind)]

    def search(self, texts: list[bytes]):
        """Per text: (words, [(first word, word after the last) of each run of hit words], item names)."""
        data, spaces, ends = written(texts)
        turns = np.zeros(len(spaces) + 1, np.int64)
        pairs = []
        for group in self.classes:
            for start, pattern in group.occurrences(data, self.pool):
                if len(start):
                    first = np.searchsorted(spaces, start)
                    np.add.at(turns, first, 1)
                    np.add.at(turns, first + self.words[pattern], -1)
                    pairs.append(np.unique(np.stack((np.searchsorted(ends, start) - 1, pattern), 1), axis=0))
        edges = np.searchsorted(spaces, ends)
        n_words = np.diff(edges) - 1
        out = [(n, [], []) for n in n_words.tolist()]
        if pairs:
            hit = np.concatenate(([0], (np.cumsum(turns[:-1]) > 0).astype(np.int8), [0]))
            change = np.diff(hit)
            lows, highs = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            texts_of = np.searchsorted(edges, lows, "right") - 1
            for t, a, z in zip(texts_of.tolist(), lows.tolist(), highs.tolist(), strict=True):
                out[t][1].append((a - int(edges[t]), z - int(edges[t])))
            named: dict[int, set] = {}
            for t, p in np.unique(np.concatenate(pairs), axis=0).tolist():
                named.setdefault(t, set()).update(self.names[i] for i in self.items[self.items_from[p]:self.items_from[p + 1]].tolist())
            for t, names in named.items():
                out[t][2].extend(sorted(names))
        return out


def pattern_tables(items: list[tuple[str, bytes]], window: int = WINDOW, limit: int = TABLE_WINDOWS):
    """Tables of ``limit`` windows at most that together hold every window of ``items`` (name, text)."""
    pool, spaces, ends = written([t for _, t in items])
    edges = np.searchsorted(spaces, ends)
    n_words = np.diff(edges) - 1
    count = np.where(n_words > 0, np.maximum(n_words - window + 1, 1), 0)
    before = np.concatenate(([0], np.cumsum(count)))
    for low in range(0, int(before[-1]), limit):
        row = np.arange(low, min(low + limit, int(before[-1])))
        owner = np.searchsorted(before, row, "right") - 1
        first = edges[owner] + row - before[owner]
        words = np.minimum(n_words[owner], window)
        at, z = spaces[first], spaces[first + words] + 1
        mine = pool[at[0]:z.max()]
        used = sorted(set(owner.tolist()))
        names = [items[i][0] for i in used]
        yield PatternTable(np.concatenate((mine, np.zeros(8, np.uint8))), at - at[0], z - at, words, np.searchsorted(used, owner), names)


def _item_blocks(items: DataFrame):
    """The items (name, text bytes), ``BLOCK_BYTES`` of text at a time (one item at least)."""
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 if total <= BLOCK_BYTES else -(-2 * total // BLOCK_BYTES)
    for i in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("name", "t"), F.lit(n)) == i)
        got = [(r["name"], bytes(r["t"])) for r in part.select("name", F.col("t").cast("binary").alias("t")).collect()]
        if got:
            yield got


def _pass(rows: DataFrame, table: PatternTable | None, id_kind: str, hits_only: bool) -> DataFrame:
    def run(batches):
        for b, texts in text_chunks(batches, 2, 1 << 22):
            if table is None:
                got = [(n, [], []) for n in _words(texts)]
            else:
                got = table.search(texts)
            take = [i for i, g in enumerate(got) if g[1] or not hits_only]
            if take:
                spans = [[{"first": a, "until": z} for a, z in got[i][1]] for i in take]
                part = b.take(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([got[i][0] for i in take], pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("until", pa.int64())]))),
                     pa.array([got[i][2] for i in take], pa.list_(pa.string()))],
                    names=["doc_id", "h", "n_words", "spans", "items"])

    return rows.mapInArrow(run, f"doc_id {id_kind}, h long, n_words long, spans array<struct<first:long,until:long>>, items array<string>")


def _words(texts: list[bytes]) -> list[int]:
    _, spaces, ends = written(texts)
    return (np.diff(np.searchsorted(spaces, ends)) - 1).tolist()


def hit_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: (doc_id, n_words, spans, items). ``spans`` are its runs of words inside occurrences of
    windows (first word from 0, word after the last), ``items`` the ids of the items whose windows occur."""
    spark = docs.sparkSession
    executors_ready(spark)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    single = rows.select("doc_id", F.lit(0).cast("long").alias("h"), "t")
    keyed = rows.select("doc_id", F.xxhash64("t").alias("h"), "t")
    named = items.select(F.coalesce(items[item_col].cast("string"), F.lit("")).alias("name"), text_of(items, item_text_col).alias("t"))
    tables = (t for block in _item_blocks(named) for t in pattern_tables(block, window))
    first, second = next(tables, None), next(tables, None)
    if second is None:
        return _pass(single, first, id_kind, False).drop("h")
    base = stored(_pass(keyed, first, id_kind, False), "leaks-base")
    found = base.filter(F.size("items") > 0).drop("n_words")
    while second is not None:
        found = found.unionByName(stored(_pass(keyed, second, id_kind, True).drop("n_words"), "leaks-hits"))
        second = next(tables, None)
    key = ["doc_id", "h"]
    spans = found.select(*key, F.explode("spans").alias("s")).select(*key, "s.*").distinct()
    earlier = Window.partitionBy(*key).orderBy("first", "until")
    spans = spans.withColumn("reach", F.max("until").over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("run", F.sum((F.col("reach").isNull() | (F.col("first") > F.col("reach"))).cast("long")).over(earlier))
    runs = spans.groupBy(*key, "run").agg(F.min("first").alias("first"), F.max("until").alias("until"))
    runs = runs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("first", "until"))).alias("all_spans"))
    named = found.select(*key, F.explode("items").alias("item")).groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("all_items"))
    both = stored(runs.join(named, [runs.doc_id.eqNullSafe(named.doc_id), runs.h == named.h])
                  .select(runs.doc_id.alias("hit_id"), runs.h.alias("hit_h"), "all_spans", "all_items"), "leaks-merged")
    out = base.join(both, base.doc_id.eqNullSafe(both.hit_id) & (base.h == both.hit_h), "left")
    return out.select("doc_id", "n_words", F.coalesce("all_spans", "spans").alias("spans"), F.coalesce("all_items", "items").alias("items"))


def contamination(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    spans = hit_spans(docs, items, **names)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["until"] - s["first"])
    return spans.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"))


_CLEAN = ("regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_CLEAN.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_CLEAN.format("coalesce(text, '')")} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS l, array_to_string(w[k:k + {WINDOW} - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT r, k, l, array_to_string(w[k:k + l - 1], ' ') AS win
       FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM d JOIN sizes ON len(w) >= l)),
hits AS (SELECT r, k, dw.l AS l, item FROM dw JOIN iw USING (win) WHERE dw.l = iw.l),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + l)) AS p FROM (SELECT DISTINCT r, k, l FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN named USING (r)
"""
