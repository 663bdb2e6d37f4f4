import itertools
import random
import zlib

import numpy as np
import pytest

from pulsevault.llm.line_quality import (
    N_OWN, LineField, _messages, fit, good_documents, labelled_sample, line_features, quality_scores,
)

SCHEMA = "doc_id long, text string, score double, held_out string"
LABELS = "doc_id long, quality int, text string"


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    good = lambda: " ".join(word() for _ in range(rng.randint(4, 20))).capitalize() + "."
    bad = lambda: rng.choice([lambda: " | ".join(word() for _ in range(9)), lambda: "!! ".join(word().upper() for _ in range(9)),
                              lambda: " ".join([word()] * 15), lambda: " ".join(word() + "###" for _ in range(8))])()
    docs, labels = [], []
    for i in range(n):
        is_bad = rng.random() < .3
        lines = [bad() if is_bad and rng.random() < .8 else good() for _ in range(rng.randint(1, 12))]
        if is_bad:
            lines[rng.randrange(len(lines))] = bad()
        docs.append((i, "\n".join(lines), .1, "x"))
        if rng.random() < .8:
            labels.append((i, int(not is_bad), "y"))
    return docs, labels


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 3, 6])
    s, pair = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    ahead, behind = _messages(s, lengths, pair)
    got = 1 / (1 + np.exp(-(ahead + behind)))
    at = 0
    for n in lengths:
        total, bad = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(s[at + t] * y for t, y in enumerate(labels)) + sum(pair[a, b] for a, b in itertools.pairwise(labels)))
            total += w
            bad += w * np.array(labels)
        assert got[at:at + n] == pytest.approx(bad / total)
        at += n


def test_features_do_not_leak_between_texts():
    texts = [b"One line.\nTwo | two", b"", b"\n\n", "é Ü!".encode(), b"One line.\nTwo | two"]
    x, per_text, size = line_features(texts)
    assert per_text.tolist() == [2, 1, 3, 1, 2] and len(x) == 9 == len(size)
    at = 0
    for t, n in zip(texts, per_text, strict=True):
        assert np.array_equal(line_features([t])[0], x[at:at + n])
        at += n
    assert x[0, N_OWN:2 * N_OWN].sum() == 0 and np.array_equal(x[1, N_OWN:2 * N_OWN], x[0, :N_OWN])


def test_held_out_accuracy_and_kept_rows(spark):
    docs, labels = corpus(2, 500)
    table, known = spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS)
    rows = {r.doc_id: r for r in quality_scores(table, known).collect()}
    assert len(rows) == len(docs)
    truth = {i: q for i, q, _ in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert np.mean([rows[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows.values())
    kept = good_documents(table, known)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.predicted == 1}


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(3, 200)
    table = spark.createDataFrame(docs, SCHEMA)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (quality_scores(table, spark.createDataFrame(rows, LABELS)).orderBy("doc_id").collect() for rows in (labels, turned))
    assert a == b


def test_edge_cases(spark):
    docs = [(1, None, .1, "x"), (1, None, .1, "x"), (None, "", .1, "x"), (2, "word " * 50_000, .1, "x"), (3, "a\n" * 3000, .1, "x")]
    table = spark.createDataFrame(docs, SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in quality_scores(table, none).collect()] == [.5] * 5
    labels = spark.createDataFrame([*corpus(4, 60)[1], (None, 1, "y"), (3, None, "y"), (5, 0, "y"), (5, 1, "y")], LABELS)
    more = spark.createDataFrame(corpus(4, 60)[0], SCHEMA).unionByName(table)
    assert quality_scores(more, labels).filter("score is null or not score between 0 and 1").count() == 0
    assert quality_scores(table.limit(0), labels).count() == 0
    assert labelled_sample(labels, "doc_id", "quality", 7, 3, 1).count() == 7


def test_single_class_has_no_opinion():
    x, n, size = line_features([b"a b c"])
    field = fit([(x, size, 1)])
    assert isinstance(field, LineField) and field.scores([b"a", b""]).tolist() == [.5, .5]
