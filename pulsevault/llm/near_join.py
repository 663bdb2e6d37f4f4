"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

1. One pass over the texts hashes every word n-gram (64 bits), and per text keeps a 128-bit digest of
   the n-gram set (the node) and one hash per band of ``rows`` MinHash values. Bands and rows are chosen
   by :func:`banding` for a target recall at the threshold.
2. Texts with equal sets are one node from here on, so copies are never expanded.
3. Nodes are shuffled on their band hashes. Every node of a bucket is tied to the bucket's smallest
   node (never to all others), and connected components of these ties are the candidate families.
4. The texts of families of two and more are read again, cut into n-grams, and compared within the family
   on the full sets. A family above ``BLOCK`` nodes is dealt into blocks, and each pair of blocks is a
   group of its own, so no task holds more than two blocks whatever the family's size. Comparing gives
   counts of links and a spanning forest, not a row for each pair.
5. Components of the forests are the classes.

All pairs of a family are compared, so a verified link is missed only if its two texts share no band and
no chain of bands.

Defined results: words are runs of anything but ASCII white space, ASCII letters lower-cased; a text of
1 to n-1 words is one n-gram; texts without words (null too) equal each other and link to nothing else;
repeated rows are documents of their own with equal sets; null ids are allowed, the class id is the
smallest non-null id; an empty table gives an empty table; only the id and the text are read, so other
columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import executors_ready, small_or, stored, text_chunks, text_of, unused
from pulsevault.llm.graph import components
from pulsevault.llm.words import joined, mixed, word_hashes

N_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 160
#: Nodes, and n-grams of all nodes together, that one side of a comparison holds, about.
BLOCK = 256
BLOCK_GRAMS = 1 << 18
BROADCAST_NODES = 300_000
_CHUNK = 4096


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows per band for which some number of bands within
    ``max_hashes`` finds a pair at the threshold with probability ``recall``."""
    for rows in range(max_hashes, 0, -1):
        bands = 1
        while bands * rows <= max_hashes:
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                return bands, rows
            bands += 1
    raise ValueError("no banding reaches the recall within max_hashes")


def ngram_sets(texts: list[bytes], n: int = N_WORDS) -> list[np.ndarray]:
    """The sorted set of n-gram hashes of each text."""
    data, bounds = joined(texts)
    words, at = word_hashes(data, lower=True)
    edges = np.searchsorted(at, bounds)
    places = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        grams += words[i:i + len(grams)] * places[i]
    grams = mixed(grams)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(mixed(np.array([(words[a:b] * places[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(grams: np.ndarray) -> bytes:
    """128-bit digest of an n-gram set."""
    import hashlib
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


class _MinHash:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(90210)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        self.place = rng.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        """One hash per band."""
        low = None
        for i in range(0, len(grams), _CHUNK):
            part = (np.multiply.outer(self.a, grams[i:i + _CHUNK]) + self.b[:, None]).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        return mixed((low.reshape(self.bands, self.rows) * self.place).sum(axis=1, dtype=np.uint64) ^ self.band)


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, node, n_grams, keys) per row; ``keys``: one hash per band, none for a text without words."""
    executors_ready(docs.sparkSession)
    text = text_of(docs, text_col)
    source = docs.select(docs[id_col].alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("text_hash"))

    def run(batches):
        import pyarrow as pa
        hashed = _MinHash(bands, rows)
        for b, texts in text_chunks(batches, 1):
            sets = ngram_sets(texts, n)
            keys = [hashed(g).astype(np.int64) if len(g) else np.zeros(0, np.int64) for g in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(map(node_of, sets), pa.binary()), pa.array(map(len, sets), pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "node", "n_grams", "keys"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text_hash long, node binary, n_grams long, keys array<long>")


def candidate_families(nodes: DataFrame) -> DataFrame:
    """(node, family) of the nodes that share a band key with another node, directly or over others."""
    keyed = stored(nodes.select("node", F.explode("keys").alias("key")), "near-keys")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"))
    buckets = stored(buckets.filter("n > 1").select("key", "a"), "near-buckets")
    ties = keyed.join(buckets, "key").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
    return components(ties, "near-families").withColumnRenamed("root", "family")


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, within: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one of ``left``, one of ``right``) whose sets reach the threshold; every unordered pair
    once if the two sides are the same (``within``)."""
    sizes = np.array([len(s) for s in sets])
    grams = np.concatenate(sets)
    _, column, times = np.unique(grams, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner = np.repeat(np.arange(len(sets)), sizes)[shared]
    _, column = np.unique(column[shared], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    width = max(1, (1 << 22) // max(len(left), len(right), 1))
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        rows, cols = owner[a:b], column[a:b] - k * width
        one, two = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        inside = place[0, rows] >= 0
        one[place[0, rows[inside]], cols[inside]] = 1
        inside = place[1, rows] >= 0
        two[place[1, rows[inside]], cols[inside]] = 1
        common += one @ two.T
    either = sizes[left][:, None] + sizes[right][None, :] - common
    linked = common >= threshold * either - 1e-6
    if within:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return left[i], right[j]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(group: list[tuple], threshold: float):
    """Rows (node, root, texts, docs) of one group of (node, side, copies, grams): links to the others."""
    rows = sorted({r[0]: r for r in group}.values())
    sets = [np.frombuffer(r[3], np.uint64) for r in rows]
    side = np.array([r[1] for r in rows])
    copies = np.array([r[2] for r in rows], np.int64)
    within = (side == 2).any()
    every = np.arange(len(rows))
    left, right = (every, every) if within else (every[side == 0], every[side == 1])
    if not len(left) or not len(right):
        return
    a, b = _links(sets, left, right, within, threshold)
    root = _forest(len(rows), a, b)
    texts = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
    docs = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
    for i in np.flatnonzero(texts):
        yield rows[i][0], rows[root[i]][0], int(texts[i]), int(docs[i])


def verified(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, n: int, threshold: float) -> DataFrame:
    """Stored (node, root, texts, docs, whole) of compared groups; ``members``: (one, node, family, copies,
    n_grams), one per node, ``one`` being (doc_id, text_hash) of a text of the node: a null or repeated id alone would
    name many texts. ``whole``: the group is the whole family, so its roots are final."""
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("n_grams") / F.lit(BLOCK_GRAMS))).cast("int")
    sizes = stored(members.groupBy("family").agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("n")), "near-sizes")
    plan = members.join(sizes.filter("n > 1").drop("n"), "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    plan = stored(plan.select(F.col("one.doc_id").alias("__id"), F.col("one.text_hash").alias("__hash"), "node", "family", "copies", "block", "blocks"),
                  "near-plan")
    _, marked = small_or(plan, BROADCAST_NODES)
    text = text_of(docs, text_col)
    source = docs.select(docs[id_col].alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("h"))
    match = source["doc_id"].eqNullSafe(marked["__id"]) & (source["h"] == marked["__hash"])
    source = source.join(marked, match).select("t", "node", "family", "copies", "block", "blocks")

    def cut(batches):
        import pyarrow as pa
        seen: set = set()  # rows with one id and text give their node once a task
        for b, texts in text_chunks(batches, 0):
            new = [i for i, x in enumerate(b.column(1).to_pylist()) if x not in seen and not seen.add(x)]
            b, texts = b.take(pa.array(new, pa.int64())), [texts[i] for i in new]
            if not texts:
                continue
            sets = ngram_sets(texts, n)
            mine = np.flatnonzero([node_of(g) == x.as_py() for g, x in zip(sets, b.column(1), strict=True)])
            rest = [b.column(i).take(pa.array(mine)) for i in range(1, 6)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([sets[i].tobytes() for i in mine], pa.binary())],
                                             names=["node", "family", "copies", "block", "blocks", "grams"])

    sets = source.mapInArrow(cut, "node binary, family binary, copies long, block int, blocks int, grams binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = sets.select("*", other).select(
        "node", "copies", "grams", "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        (F.col("blocks") == 1).alias("whole"))
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")

    def compare(batches):
        import pyarrow as pa
        kind = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("texts", pa.int64()), ("docs", pa.int64()), ("whole", pa.bool_())])

        def done(group, whole):
            out = [(*r, whole) for r in _compared(group, threshold)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 5, kind, strict=True)], schema=kind)

        key, group, whole = None, [], False
        for b in (part.slice(at, 256) for part in batches for at in range(0, part.num_rows, 256)):
            for node, copies, grams, family, i, j, side, all_of_it in zip(*(b.column(k).to_pylist() for k in range(8)), strict=True):
                if (family, i, j) != key:
                    if group:
                        yield done(group, whole)
                    key, group, whole = (family, i, j), [], all_of_it
                group.append((node, side, copies, grams))
        if group:
            yield done(group, whole)

    found = dealt.select("node", "copies", "grams", "family", "i", "j", "side", "whole")
    return stored(found.mapInArrow(compare, "node binary, root binary, texts long, docs long, whole boolean"), "near-links")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                 threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, class_id (smallest id of its class), class_size (documents), n_links (other
    documents that reach the threshold, copies included), n_text_links (other n-gram sets that do), root
    (the class's key, there for null ids too), text_hash."""
    bands, rows = banding(threshold, recall)
    sigs = stored(signatures(docs, id_col, text_col, n, bands, rows), "near-signatures")
    nodes = stored(sigs.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("one"),
                                            F.count(F.lit(1)).alias("copies"),
                                            F.first("n_grams").alias("n_grams"), F.first("keys").alias("keys")), "near-nodes")
    families = candidate_families(nodes)
    members = nodes.select("one", "node", "copies", "n_grams").join(families, "node")
    links = verified(docs, members, id_col, text_col, n, threshold)
    whole = links.filter("whole").select("node", "root")
    parts = components(links.filter("not whole").select(F.col("root").alias("a"), F.col("node").alias("b")), "near-classes")
    roots = whole.unionByName(parts)
    degree = links.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    info = nodes.select("node", "doc_id", "copies").join(roots, "node", "left").join(degree, "node", "left")
    info = stored(info.withColumn("root", F.coalesce("root", "node")), "near-info")
    classes = info.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    classes = stored(classes, "near-class-ids")
    info = stored(info.join(classes, "root").select("node", "root", "class_id", "class_size", "copies", "texts", "docs"), "near-decisions")
    return sigs.select("doc_id", "text_hash", "node").join(info, "node").select(
        "doc_id", "class_id", "class_size", (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"), "root", "text_hash")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of ``docs`` per class, with its columns: the one with the smallest id, of several such the
    one whose text has the smallest hash."""
    found = near_classes(docs, id_col, text_col, **params).filter("class_size > 1")
    found = stored(found.groupBy("root", "doc_id", "class_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "near-members")
    winner = stored(found.filter("doc_id <=> class_id").groupBy("root").agg(F.min("text_hash").alias("best")), "near-winners")
    judged = found.join(winner, "root").withColumn("stays", F.expr("doc_id <=> class_id and text_hash = best"))
    judged = stored(judged.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "stays", "n"), "near-judged")
    text_hash = F.xxhash64(text_of(docs, text_col))
    match = lambda right: docs[id_col].eqNullSafe(right["__id"]) & (text_hash == right["__hash"])
    _, drop = small_or(judged.filter("not stays").select("__id", "__hash"), BROADCAST_NODES)
    kept = docs.join(drop, match(drop), "left_anti")
    repeated = judged.filter("stays and n > 1").select("__id", "__hash")
    if repeated.isEmpty():
        return kept
    _, repeated = small_or(repeated, BROADCAST_NODES)
    own = unused(docs, "__own_hash")
    once = kept.join(repeated, match(repeated), "left_semi").withColumn(own, text_hash).dropDuplicates([id_col, own])
    return kept.join(repeated, match(repeated), "left_anti").unionByName(once.drop(own))
