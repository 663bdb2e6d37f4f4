import math

import numpy as np
import pytest

from pulsevault.llm import ann_graph
from pulsevault.llm.ann_graph import _best, _local_join, blocks_of, nearest, neighbour_graph, nodes_of, round_offers, valid_vectors

SCHEMA = "vec_id long, embedding array<float>, score string, node int"


def truth(rows, every, k):
    """{query id: [(vec_id, cosine)]} by brute force."""
    vectors = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    sizes = [len(v) for _, v in vectors]
    size = min((-sizes.count(n), n) for n in set(sizes))[1]
    vectors = [(i, np.float32(v).astype(float)) for i, v in vectors if len(v) == size]
    out = {}
    for q, a in vectors:
        if q % every == 0:
            scored = [(-(a @ b) / math.sqrt(a @ a) / math.sqrt(b @ b), i) for i, b in vectors if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scored)[:k]]
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann_graph, "GROUP", 300)  # so that the start finds few neighbours and the descent the rest
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[100:140] = x[100] + .001 * rng.normal(size=(40, 24))
    rows = [(int(i), [float(c) for c in v], "x", 1) for i, v in enumerate(x)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, SCHEMA).repartition(5), 50, block=700).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = truth(rows, 50, 5)
    assert set(got) == set(want) and all([p for p, *_ in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values())
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 5 >= 0.95
    for q, found in got.items():
        a = x[q].astype(float)
        for _, i, s in found:
            b = x[i].astype(float)
            assert s == pytest.approx(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b), abs=1e-12)


def test_small_and_odd_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=4)], "x", 1) for i in range(30)]
    same = [1.0, 2.0, 0.0, -1.0]
    rows += [(100 + i, same, "x", 1) for i in range(40)] + [(100, same, "x", 1)]
    rows += [(300, None, "x", 1), (350, [], "x", 1), (400, [0.0] * 4, "x", 1), (450, [1.0, None, 1.0, 1.0], "x", 1), (None, same, "x", 1),
             (500, [1.0, float("nan"), 1.0, 1.0], "x", 1), (550, [float("inf"), 1.0, 1.0, 1.0], "x", 1), (600, [1.0, 2.0], "x", 1)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, SCHEMA), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 12)))
    want = truth(rows, 5, 5)
    assert {q: [(p + 1, i) for p, (i, _) in enumerate(v)] for q, v in want.items()} == {q: [(p, i) for p, i, _ in sorted(v)] for q, v in got.items()}
    few = spark.createDataFrame([(5, [1.0, 0.0], "x", 1), (7, [0.0, 1.0], "x", 1), (10, [1.0, 1.0], "x", 1)], SCHEMA)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in nearest(few, 5).collect()) == [(5, 1, 10), (5, 2, 7), (10, 1, 5), (10, 2, 7)]
    assert nearest(few.limit(0), 5).count() == 0 and nearest(few.limit(1), 5).count() == 0


def test_local_join_offers_match_all_pairs():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 5)).astype(np.float32)
    worst = rng.normal(size=12).astype(np.float32)
    owner = np.array([0, 0, 0, 0, 3, 3, 3])
    member, fresh = np.array([1, 4, 5, 9, 2, 4, 7]), np.array([True, False, True, False, False, False, True])
    to, other, sims = _local_join(x, worst, owner, member, fresh, 99)
    want = {}
    for o in (0, 3):
        at = np.flatnonzero(owner == o)
        for i in at:
            for j in at:
                if i != j and (fresh[i] or fresh[j]):
                    s = x[member[i]] @ x[member[j]]
                    if s > worst[member[i]]:
                        want[member[i], member[j]] = s
    assert {(a, b): pytest.approx(s, abs=1e-5) for a, b, s in zip(to, other, sims, strict=True)} == want


def test_best_keeps_each_other_once():
    owner, other, sim = _best(np.array([0, 0, 0, 1, 0]), np.array([5, 6, 5, 5, 7]), np.array([.1, .3, .1, .9, .2], np.float32), 2)
    assert list(zip(owner, other, strict=True)) == [(0, 6), (0, 7), (1, 5)]


def test_as_many_copies_as_asked_for(spark):
    rows = [(i, [1.0, 2.0], "x", 1) for i in range(40)] + [(50 + i, [-1.0, float(i)], "x", 1) for i in range(3)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, SCHEMA), 5, k=25).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = truth(rows, 5, 25)
    assert {q: [(p + 1, i) for p, (i, _) in enumerate(v)] for q, v in want.items()} == {q: sorted(v) for q, v in got.items()}


def test_reverse_edges_of_a_hub_are_cut_before_the_shuffle(spark):
    half = np.zeros(4, np.float16).tobytes()
    rows = [(0, i, half, [0] if i else [1], [0.5], [True]) for i in range(500)]  # all point to node 0
    graph = spark.createDataFrame(rows, "block int, node long, half binary, ids array<long>, sims array<float>, fresh array<boolean>").repartition(4)
    text = round_offers(graph, 4, 8, 0)._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line and ", 8," in line for line in limits) and any("Final" in line for line in limits)


def test_a_vector_is_joined_once_however_many_blocks_ask_for_it(spark):
    half = np.zeros(4, np.float16).tobytes()
    rows = [(i % 4, i, half, [0] if i else [1], [0.5], [True]) for i in range(40)]
    graph = spark.createDataFrame(rows, "block int, node long, half binary, ids array<long>, sims array<float>, fresh array<boolean>")
    text = round_offers(graph, 4, 8, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(blocks" in text and text.index("Generate explode(blocks") < text.index("Join [other")


def test_copies_of_a_vector_do_not_grow_with_the_table(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(ann_graph, "round_offers", lambda graph, blocks, *rest: dealt.append(blocks) or round_offers(graph, blocks, *rest))
    rng = np.random.default_rng(4)
    for n in (400, 2000):
        rows = [(i, [float(c) for c in rng.normal(size=8)], "x", 1) for i in range(n)]
        assert nearest(spark.createDataFrame(rows, SCHEMA), 50, block=100, rounds=1).count() == n // 50 * 5
    assert len(dealt) == 2 and dealt[0] == dealt[1]
    # as many blocks for five times the vectors; a block never holds more vectors than one of a large table may ask for
    assert blocks_of(10_256, 4096, 32) == blocks_of(51_282, 4096, 32)
    assert blocks_of(262_144, 4096, 32) == 16 and blocks_of(262_145, 4096, 32) == 65


def test_the_graph_does_not_depend_on_the_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_graph, "GROUP", 100)
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=8)], "x", 1) for i in range(700)]
    nodes, _, n = nodes_of(valid_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding"), 5)
    graphs = []
    for blocks, merged, held in ((1, 4096, 1 << 20), (30, 50, 10)):
        monkeypatch.setattr(ann_graph, "blocks_of", lambda *_, b=blocks: b)
        monkeypatch.setattr(ann_graph, "MERGED", merged)
        monkeypatch.setattr(ann_graph, "HELD", held)
        graph = neighbour_graph(nodes, n, degree=8, rounds=2)
        graphs.append({r.node: dict(zip(r.ids, (round(s, 5) for s in r.sims), strict=True)) for r in graph.collect()})
        assert graph.select("block").distinct().count() == blocks
    assert graphs[0] == graphs[1] and all(len(v) == 8 for v in graphs[0].values())


def test_offers_cut_while_they_are_collected_are_the_best(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    owner = np.repeat(np.arange(40), 10)
    member = np.concatenate([np.sort(rng.choice(60, 10, replace=False)) for _ in range(40)])
    fresh = rng.random(400) < .6
    whole = _local_join(x, np.full(60, -2, np.float32), owner, member, fresh, 3)
    monkeypatch.setattr(ann_graph, "HELD", 1)
    parts = _local_join(x, np.full(60, -2, np.float32), owner, member, fresh, 3)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and np.bincount(whole[0]).max() == 3
