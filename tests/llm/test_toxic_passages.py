import random
import zlib

import numpy as np
import pytest

from pulsevault.llm.toxic_passages import fitted, maximal_segments, toxic_passages, toxicity_scores

SCHEMA = "doc_id long, text string, score double, toxic string"
LABELS = "doc_id long, toxic int, text string"
BAD = ["scum", "vermin", "trash", "moron"]


def plain_segments(scores):
    """All maximal segments by definition: the best segment (shortest of equals, leftmost), then both sides of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i:j + 1])
            if s > 1e-12 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) <= 1e-9 and j - i < best[2] - best[1]):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return [*plain_segments(scores[:i]), (i, j, s), *((a + j + 1, b + j + 1, v) for a, b, v in plain_segments(scores[j + 1:]))]


def test_maximal_segments_match_the_definition():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 14)
        listed = sorted(rng.sample(range(n), rng.randint(0, n)))
        values = [rng.choice([-1.3, .7, 1.9, 3.1]) + rng.random() for _ in listed]
        scores = [-.37] * n
        for i, v in zip(listed, values, strict=True):
            scores[i] = v
        got = maximal_segments(np.array(values), np.array(listed, dtype=int), -.37)
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 300))]
        toxic = rng.random() < .25
        if toxic:
            at = rng.randrange(len(words))
            for k in range(rng.randint(2, 5)):
                words.insert(at + 2 * k, rng.choice(BAD).upper() + rng.choice(",. !"))
        docs.append((i, " ".join(words), .5, "x"))
        if rng.random() < .8:
            labels.append((i, int(toxic), "y"))
    return docs, labels


def test_held_out_accuracy_and_passages(spark):
    docs, labels = corpus(2, 600)
    table, known = spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS)
    rows = {r.doc_id: r for r in toxicity_scores(table, known).collect()}
    truth = {i: q for i, q, _ in labels}
    crc = lambda i: zlib.crc32(str(i).encode()) % 4
    assert len(rows) == len(docs) and all(r.held_out == (crc(i) == 2) for i, r in rows.items())
    held = [i for i in truth if crc(i) == 2]
    assert np.mean([rows[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .3) for r in rows.values())
    found = toxic_passages(table, fitted(table, known)).collect()
    text = {i: t for i, t, *_ in docs}
    assert found and all(text[r.doc_id].encode()[r.first_byte:r.end_byte].decode() == r.passage for r in found)
    assert all(any(b in r.passage.lower() for b in BAD) for r in found)


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(3, 200)
    table = spark.createDataFrame(docs, SCHEMA)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    a, b = (toxicity_scores(table, spark.createDataFrame(rows, LABELS)).orderBy("doc_id").collect() for rows in (labels, turned))
    assert a == b


def test_edge_cases(spark):
    docs = [(1, None, .1, "x"), (1, None, .1, "x"), (None, "", .1, "x"), (2, "scum " * 50_000, .1, "x"), (3, "!!! ...", .1, "x")]
    table = spark.createDataFrame(docs, SCHEMA)
    assert {r.score for r in toxicity_scores(table, spark.createDataFrame([], LABELS)).collect()} == {0.0}
    more, labels = corpus(4, 120)
    every = spark.createDataFrame(more, SCHEMA).unionByName(table)
    known = spark.createDataFrame([*labels, (None, 1, "y"), (3, None, "y"), (5, 0, "y"), (5, 1, "y")], LABELS)
    got = toxicity_scores(every, known)
    assert got.count() == 125 and got.filter("score is null or not score between 0 and 1").count() == 0
    assert toxicity_scores(table.limit(0), known).count() == 0
