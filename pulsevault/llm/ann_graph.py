"""Approximate nearest neighbours: a neighbour graph by NN-descent, queries by greedy graph search.

Nodes are the different vectors (equal ones are one node with members). Every node starts with its
nearest nodes within a few random groups. Each round of NN-descent joins a node's neighbours, forward and
reverse, with each other: a pair of which at least one is new to the node is compared, and each of the
two is offered the other if that beats its worst neighbour. Rounds end when few neighbours change.

The joins run by blocks of nodes: a block asks for the vectors of its nodes' neighbours (one row per block and
neighbour), compares inside the block, and sends at most ``DEGREE`` offers per block and node; another shuffle
merges the offers into the graph. No task holds more than one block with the vectors it asked for. A vector
goes to all blocks that ask for it, ``2 * DEGREE`` at most on average, so blocks are no more than needed: ``BLOCKS``
of up to ``WIDER * BLOCK`` nodes while all vectors are no more than ``BLOCK`` nodes may ask for, else blocks of
``BLOCK`` nodes. Their number changes no result. Reverse neighbours of a node beyond ``DEGREE`` are left to later rounds by a hash
order, which is part of the descent and loses no row: every vector is indexed.

A search starts at an entry node (a query that is a row of the table starts at itself), and expands the
best ``WIDTH`` nodes known until all of them have been expanded (at most ``HOPS`` joins). All queries
advance together, a hop being a few joins of (query, node) rows.

Defined results: vectors that are null, empty, zero, or hold null or non-finite parts, vectors of another
than the most frequent length, and rows without id take no part; equal vectors tie, smaller ids first;
a row that repeats id and vector counts once; fewer candidates than asked for give fewer rows; an empty table gives
an empty table; only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType

from pulsevault.llm.common import executors_ready, stored

DEGREE = 32
#: Nodes in a block of a large table, how many times as many where all vectors fit, and blocks of a round at least.
BLOCK, WIDER, BLOCKS = 4096, 4, 8
#: Nodes whose offers are merged at a time, and offers of a block that are held before they are cut, at least.
MERGED, HELD = 4096, 4 << 20
#: Random groups per node at the start, and nodes in a group.
STARTS, GROUP = 3, 2048
ROUNDS, MIN_CHANGE = 8, 0.01
WIDTH, HOPS = 128, 6
#: Vectors of a query's answer that are measured exactly, beyond those asked for.
SPARE = 4


def valid_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Stored (vec_id, vec): the rows that take part, vectors in double precision."""
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[vec_col].cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("vec").alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "k").first()
    return stored(rows.filter(F.size("vec") == (sizes["k"] if sizes else 0)), "ann-vectors")


def _unit(vectors: pa.Array, kind) -> pa.Array:
    if not len(vectors):
        return pa.array([], pa.binary())
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(kind)
    return pa.array([r.tobytes() for r in x], pa.binary())


def _unit_single(v: pa.Array) -> pa.Array:
    return _unit(v, np.float32)


def _unit_half(v: pa.Array) -> pa.Array:
    return _unit(v, np.float16)


def nodes_of(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """Stored nodes (node, unit, half, vec), stored members (node, vec_id: the ``k + 1`` smallest of each node,
    which hold ``k`` others for any row), and the number of nodes. A node is named by its smallest id."""
    unit = F.arrow_udf(_unit_single, BinaryType())
    half = F.arrow_udf(_unit_half, BinaryType())
    same = Window.partitionBy("vec")
    few = rows.withColumn("rank", F.row_number().over(same.orderBy("vec_id"))).filter(F.col("rank") <= k + 1)
    members = stored(few.withColumn("node", F.min("vec_id").over(same)), "ann-members")
    first = members.filter("rank = 1")
    n = first.count()
    nodes = first.select("node", unit("vec").alias("unit"), half("vec").alias("half"), "vec")
    return stored(nodes, "ann-nodes"), members.select("node", "vec_id"), n


def blocks_of(n: int, block: int, degree: int) -> int:
    """The number of blocks of ``n`` nodes. ``block`` nodes ask for ``2 * degree * block`` vectors at most; a table of
    no more vectors than that is dealt to larger blocks, so that a vector's copies do not grow with the table."""
    return max(BLOCKS, -(-n // (block * WIDER if n <= 2 * degree * block else block)))


def _block(node: str, blocks: int):
    return F.pmod(F.xxhash64(node), F.lit(blocks)).cast("int").alias("block")


def _rows(column: pa.Array, kind) -> np.ndarray:
    """The equally long binaries of a column as a matrix."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind).reshape(len(parts), -1)


def _lists(owner: np.ndarray, n: int, *values) -> list[pa.Array]:
    """List columns from flat values that are sorted by ``owner`` (0 to n-1)."""
    offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32), pa.int32())
    return [pa.ListArray.from_arrays(offsets, v) for v in values]


def _rank(owner: np.ndarray) -> np.ndarray:
    """Place of each entry within its owner's run."""
    if not len(owner):
        return owner
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))


def _best(owner: np.ndarray, other: np.ndarray, sim: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``degree`` best different others of every owner, sorted."""
    order = np.lexsort((other, -sim, owner))
    owner, other, sim = owner[order], other[order], sim[order]
    by = np.lexsort((other, owner))
    twice = np.zeros(len(owner), bool)
    twice[by[1:]] = (owner[by[1:]] == owner[by[:-1]]) & (other[by[1:]] == other[by[:-1]])
    owner, other, sim = owner[~twice], other[~twice], sim[~twice]
    keep = _rank(owner) < degree
    return owner[keep], other[keep], sim[keep]


def _grouped(batches, key_columns: int):
    """Runs of equal leading columns over sorted batches, as (key, [batch slices])."""
    key, held = None, []
    for b in batches:
        keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(key_columns)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            if z > a:
                mine = tuple(keys[:, a].tolist())
                if mine != key and held:
                    yield key, held
                    held = []
                key = mine
                held.append(b.slice(a, z - a))
    if held:
        yield key, held


_OFFERS = "node long, ids array<long>, sims array<float>"


def _offers(node: np.ndarray, owner: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    lists = _lists(owner, len(node), pa.array(ids, pa.int64()), pa.array(sims.astype(np.float32), pa.float32()))
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), *lists], names=["node", "ids", "sims"])


def first_offers(nodes: DataFrame, n: int, degree: int, starts: int, group: int) -> DataFrame:
    """Every node's nearest nodes within ``starts`` random groups of about ``group`` nodes."""
    groups = max(1, -(-n // group))

    def run(batches):
        for _, parts in _grouped(batches, 2):
            node = np.concatenate([p.column(2).to_numpy() for p in parts])
            x = np.concatenate([_rows(p.column(3), np.float16) for p in parts]).astype(np.float32)
            k = min(degree, len(node) - 1)
            for at in range(0, len(node), 512):
                s = x[at:at + 512] @ x.T
                here = np.arange(len(s))
                s[here, at + here] = -2
                best = np.argpartition(-s, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(s), 0), np.int64)
                yield _offers(node[at:at + 512], np.repeat(here, k), node[best].ravel(), np.take_along_axis(s, best, 1).ravel())

    deals = F.explode(F.array(*[F.lit(t) for t in range(starts)])).alias("deal")
    dealt = nodes.select(deals, "node", "half").select(
        "deal", F.pmod(F.xxhash64("node", "deal"), F.lit(groups)).alias("group"), "node", "half")
    return dealt.repartition("deal", "group").sortWithinPartitions("deal", "group", "node").mapInArrow(run, _OFFERS)


def merged(graph: DataFrame, offers: DataFrame, blocks: int, degree: int, n: int) -> DataFrame:
    """The graph (block, node, half, ids, sims, fresh) with the offers taken in; ``fresh``: new in this merge."""
    kind = lambda k: F.lit(k).cast("byte").alias("kind")
    part = _block("node", max(blocks, -(-n // MERGED))).alias("part")
    old = graph.select(part, "node", kind(0), "half", "ids", "sims")
    new = offers.select(part, "node", kind(1), F.lit(None).cast("binary").alias("half"), "ids", "sims")
    rows = old.unionByName(new).repartition("part").sortWithinPartitions("part", "kind", "node")

    def run(batches):
        for _, parts in _grouped(batches, 1):
            b = pa.Table.from_batches(parts).combine_chunks()
            kinds = b.column(2).to_numpy()
            known = b.slice(0, int((kinds == 0).sum()))
            node = known.column(1).to_numpy()
            every = b.column(1).to_numpy()
            sizes = b.column(4).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.searchsorted(node, every), sizes)
            fresh = np.repeat(kinds == 1, sizes)
            ids = b.column(4).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            sims = b.column(5).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((fresh, ids, owner))
            owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
            keep = np.concatenate(([True], (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1]))) if len(owner) else np.zeros(0, bool)
            owner, ids, sims, fresh = owner[keep], ids[keep], sims[keep], fresh[keep]
            order = np.lexsort((ids, -sims, owner))
            order = order[_rank(owner[order]) < degree]
            lists = _lists(owner[order], len(node), pa.array(ids[order], pa.int64()), pa.array(sims[order], pa.float32()), pa.array(fresh[order]))
            half = known.column(3).combine_chunks()
            yield from pa.Table.from_arrays([pa.array(node), half, *lists], names=["node", "half", "ids", "sims", "fresh"]).to_batches(1024)

    graph = rows.mapInArrow(run, "node long, half binary, ids array<long>, sims array<float>, fresh array<boolean>")
    return graph.select(_block("node", blocks), "node", "half", "ids", "sims", "fresh")


def _local_join(x: np.ndarray, worst: np.ndarray, owner: np.ndarray, member: np.ndarray, fresh: np.ndarray, degree: int):
    """Offers (to, other, similarity) among the members of each owner; all are row numbers of ``x``."""
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(owner))
    none = np.zeros(0, np.int32)
    held, size, limit = [(none, none, np.zeros(0, np.float32))], 0, HELD
    member = member.astype(np.int32)

    def cut():
        return _best(*(np.concatenate(v) for v in zip(*held, strict=True)), degree)

    for a, z in zip(starts.tolist(), ends.tolist(), strict=True):
        new = fresh[a:z]
        if z - a < 2 or not new.any():
            continue
        m = member[a:z]
        mine = x[m]
        first = np.flatnonzero(new)
        s = mine[first] @ mine.T
        beats = s > np.minimum(worst[m[first]][:, None], worst[m][None, :])
        # each pair once: of two new ones the earlier, never a node with itself
        beats &= ~(new[None, :] & (np.arange(len(m))[None, :] <= first[:, None]))
        i, j = np.nonzero(beats)
        s = s[i, j]
        for to, other in ((m[first[i]], m[j]), (m[j], m[first[i]])):
            use = s > worst[to]
            held.append((to[use], other[use], s[use]))
            size += len(held[-1][0])
        if size > limit:
            held = [cut()]
            size = len(held[0][0])
            limit = 2 * size + HELD
    return cut()


def round_offers(graph: DataFrame, blocks: int, degree: int, turn: int) -> DataFrame:
    """Offers of one round: neighbours of a node are joined with each other."""
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    kind = lambda k: F.lit(k).cast("byte").alias("kind")
    edges = graph.select("block", "node", F.explode(F.arrays_zip("ids", "fresh")).alias("e")).select(
        "block", "node", F.col("e.ids").alias("other"), F.col("e.fresh").alias("flag"))
    back = edges.select(_block("other", blocks), F.col("other").alias("node"), F.col("node").alias("other"), "flag")
    # a node's reverse edges are cut (new ones first) before they and their vectors are sent to its block; the limit
    # also holds in every task before the shuffle, so a hub's edges never meet in one
    order = Window.partitionBy("node").orderBy(F.desc("flag"), F.xxhash64("node", "other", F.lit(turn)), "other")
    back = back.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= degree).drop("place")
    # a vector is joined once with the blocks that ask for it, and only then dealt to each of them
    asked = edges.select("block", "other").unionByName(back.select("block", "other")).groupBy("other").agg(F.collect_set("block").alias("blocks"))
    worst = F.when(F.size("ids") < degree, F.lit(-2.0)).otherwise(F.array_min("sims")).cast("float").alias("worst")
    payload = graph.select(F.col("node").alias("other"), "half", worst)
    vectors = asked.join(payload, "other").select(F.explode("blocks").alias("block"), kind(0), "other", "half", "worst", none("long", "node"), none("boolean", "flag"))
    links = lambda e, k: e.select("block", kind(k), "other", none("binary", "half"), none("float", "worst"), "node", "flag")
    rows = vectors.unionByName(links(edges, 1)).unionByName(links(back, 2))
    # few blocks get a task each; hashes would put several into one
    few = blocks <= int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionById(blocks, "block") if few else rows.repartition("block")
    rows = rows.sortWithinPartitions("block", "kind", "other")

    def run(batches):
        for _, parts in _grouped(batches, 1):
            kinds = np.concatenate([p.column(1).to_numpy() for p in parts])
            at = np.searchsorted(kinds, [1, 3])
            ids, vectors, floors, left = [], [], [], int(at[0])
            for p in parts:
                if left:
                    some = p.slice(0, min(left, p.num_rows))
                    ids.append(some.column(2).to_numpy())
                    vectors.append(_rows(some.column(3), np.float16).astype(np.float32))
                    floors.append(some.column(4).to_numpy(zero_copy_only=False))
                    left -= some.num_rows
            ids, x, floors = np.concatenate(ids), np.concatenate(vectors), np.concatenate(floors)
            del vectors
            links_ = pa.Table.from_batches(parts).slice(int(at[0]))
            node = links_.column(5).to_numpy()
            member = np.searchsorted(ids, links_.column(2).to_numpy())
            fresh = links_.column(6).to_numpy().astype(bool)
            order = np.lexsort((~fresh, member, node))
            node, member, fresh = node[order], member[order], fresh[order]
            keep = np.concatenate(([True], (node[1:] != node[:-1]) | (member[1:] != member[:-1])))
            to, other, sims = _local_join(x, floors, node[keep], member[keep], fresh[keep], degree)
            target, owner = np.unique(to, return_inverse=True)
            for i in range(0, len(target), 4096):
                a, z = np.searchsorted(owner, [i, i + 4096])
                yield _offers(ids[target[i:i + 4096]], owner[a:z] - i, ids[other[a:z]], sims[a:z])

    return rows.mapInArrow(run, _OFFERS)


def neighbour_graph(nodes: DataFrame, n: int, degree: int = DEGREE, rounds: int = ROUNDS, min_change: float = MIN_CHANGE,
                    block: int = BLOCK) -> DataFrame:
    """Stored graph (block, node, half, ids, sims, fresh): every node's ``degree`` nearest nodes found."""
    blocks = blocks_of(n, block, degree)
    empty = nodes.select(_block("node", blocks), "node", "half", F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("sims"))
    graph = stored(merged(empty, first_offers(nodes, n, degree, STARTS, GROUP), blocks, degree, n), "ann-graph")
    for turn in range(rounds):
        graph = stored(merged(graph, round_offers(graph, blocks, degree, turn), blocks, degree, n), "ann-graph")
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if changed <= min_change * n * degree:
            break
    return graph


def _dots(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float32())
    return pa.array((_rows(a, np.float32) * _rows(b, np.float32)).sum(axis=1, dtype=np.float32))


def _cosines(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    x, y = (v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) for v in (a, b))
    return pa.array((x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))))


def _similarity(a: str, b: str):
    return F.arrow_udf(_dots, FloatType())(a, b)


def greedy_search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, width: int = WIDTH, hops: int = HOPS) -> DataFrame:
    """Stored (query, node, sim, open) of all nodes measured for each of ``queries`` (query, unit, entry); edges
    are followed both ways, reverse ones as far as they are among the ``DEGREE`` best of a node."""
    forward = graph.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("e")).select("node", F.col("e.ids").alias("to"), F.col("e.sims").alias("sim"))
    back = forward.select(F.col("to").alias("node"), F.col("node").alias("to"), "sim")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "to"))
    back = back.withColumn("place", place).filter(F.col("place") <= DEGREE).select("node", "to")
    edges = stored(forward.select("node", "to").unionByName(back).distinct(), "ann-edges")
    units = nodes.select(F.col("node").alias("to"), F.col("unit").alias("far"))
    starts = queries.join(units, F.col("entry") == F.col("to")).select("query", F.col("entry").alias("node"), _similarity("unit", "far").alias("sim"))
    known = stored(starts.withColumn("open", F.lit(True)), "ann-known")
    best = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    for _ in range(hops):
        front = known.withColumn("place", F.row_number().over(best)).filter((F.col("place") <= width) & F.col("open"))
        front = stored(front.select("query", "node"), "ann-front")
        if front.isEmpty():
            break
        found = front.join(edges, "node").select("query", F.col("to").alias("node")).distinct()
        found = found.join(known.select("query", "node"), ["query", "node"], "left_anti")
        found = found.join(queries.select("query", "unit"), "query").join(units, F.col("node") == F.col("to"))
        found = found.select("query", "node", _similarity("unit", "far").alias("sim"), F.lit(True).alias("open"))
        seen = known.join(front.withColumn("done", F.lit(True)), ["query", "node"], "left")
        seen = seen.select("query", "node", "sim", (F.col("open") & F.col("done").isNull()).alias("open"))
        known = stored(seen.unionByName(found), "ann-known")
    return known


def nearest(table: DataFrame, every: int, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", **params) -> DataFrame:
    """The ``k`` nearest other rows of each row whose id is divisible by ``every``: query_id, rank, vec_id, score
    (cosine in double precision on the original vectors)."""
    executors_ready(table.sparkSession)
    rows = valid_vectors(table, id_col, vec_col)
    nodes, members, n = nodes_of(rows, k)
    graph = neighbour_graph(nodes, n, **params)
    asking = rows.filter(F.col("vec_id") % every == 0)
    asking = stored(asking.join(nodes.select("vec", "node"), "vec").select(F.col("vec_id").alias("query_id"), "vec", "node"), "ann-asking")
    queries = stored(asking.select("node").distinct().join(nodes, "node").select(F.col("node").alias("query"), "unit", F.col("node").alias("entry")), "ann-queries")
    known = greedy_search(graph, nodes, queries)
    best = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    top = known.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1 + SPARE).select("query", "node")
    candidates = top.join(members, "node").join(nodes.select("node", F.col("vec").alias("far")), "node").select(F.col("query").alias("node"), "vec_id", "far")
    pairs = asking.join(candidates, "node").filter(F.col("query_id") != F.col("vec_id"))
    scored = pairs.select("query_id", "vec_id", F.arrow_udf(_cosines, DoubleType())("vec", "far").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
