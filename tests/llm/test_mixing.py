import random

import pytest
from pyspark.sql import Row

from pulsevault.llm.mixing import mix, mixed_documents, source_targets

SCHEMA = "doc_id long, text string, source string, size string, key long"


def words(n):
    return " ".join(["w"] * n)


def filled(sizes, weights, cap):
    """Water filling as stated: cap, reshare the excess by weight, until none is above."""
    order = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        level = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: level * w[s] for s in free}}
        for s in over:
            fixed[s] = cap * sizes[s]
            left -= fixed[s]


def reference(rows):
    import hashlib
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = filled(sizes, (5, 2, 1), 3)
    copies = []
    for source in sizes:
        queue = sorted(((hashlib.md5(f"mix-1|{'null' if i is None else i}".encode()).hexdigest(), i is not None, i or 0,
                         hashlib.md5((t or "").encode()).hexdigest(), len((t or "").split()), i)
                        for i, t, s in rows if s == source))
        upto = 0
        for k, _, _, tie, n, i in queue:
            upto += n
            for repeat in range(3):
                at = (repeat * sizes[source] + upto) / targets[source] if targets[source] > 0 else 0.0
                copies.append((at, source is None, source or "", k, tie, repeat, i, n, source))
    taken, running, budget = {}, 0, sum(sizes.values())
    for _, _, _, _, _, _, i, n, source in sorted(copies, key=lambda c: c[:6]):
        running += n
        if running > budget:
            break
        taken[i, source] = taken.get((i, source), 0) + n
    return targets, taken


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_the_plain_procedure(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "é", "Z", None, "zz"]
    share = [30, 1, 4, 2, 9, 3, 1] if seed < 3 else [1] * 7
    rows = [(i, rng.choice([None, "", words(rng.randint(1, 40))]) if rng.random() < .2 else words(rng.randint(1, 40)),
             rng.choices(names, share)[0]) for i in range(400)]
    docs = spark.createDataFrame([(i, t, s, "x", 7) for i, t, s in rows], SCHEMA).repartition(5)
    targets, taken = reference(rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == taken.get((r.doc_id, r.source), 0)
        assert r.taken <= 3 * r["size"]
    for s in targets:
        assert abs(sum(r.taken for r in got if r.source == s) - targets[s]) <= 3 * 40
    assert sum(r.taken for r in got) <= sum(r["size"] for r in got)


def test_caps_hold_for_uneven_sources(spark):
    sized = spark.createDataFrame([Row(source=s, size=n) for s, n in (("a", 10), ("b", 1000), ("c", 30), (None, 5), ("d", 1))])
    got = {r.source: r.target for r in source_targets(sized).collect()}
    want = filled({"a": 10, "b": 1000, "c": 30, None: 5, "d": 1}, (5, 2, 1), 3)
    assert got == pytest.approx(want)


def test_mixed_rows_repeat_as_decided(spark):
    rng = random.Random(9)
    rows = [(i, words(rng.randint(1, 9)) + f" {i}", "ab"[i % 10 == 0], "x", 7) for i in range(200)] + [(7, words(3) + " 7", "a", "x", 7)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    decided = {}
    for r in mix(docs).collect():
        decided[r.doc_id] = decided.get(r.doc_id, 0) + r.taken
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert {k: v for k, v in decided.items() if v} == got


def test_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, "x", 1), (2, " \n", "a", "x", 1), (None, "", "a", "x", 1)], SCHEMA)
    assert {(r.doc_id, r["size"], r.taken) for r in mix(blank).collect()} == {(1, 0, 0), (2, 0, 0), (None, 0, 0)}
