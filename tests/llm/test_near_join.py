import random

import numpy as np
import pytest

from pulsevault.llm import near_join
from pulsevault.llm.near_join import banding, near_classes, ngram_sets, one_of_each_class

SCHEMA = "doc_id long, text string, node string, class_id long"


def shingles(text):
    w = ("".join(c.lower() if c.isascii() else c for c in text or "")).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def reference(rows):
    """{row index: (class_id, class_size, n_links, n_text_links)} by all pairs."""
    sets = [shingles(t) for _, t in rows]
    linked = lambda a, b: a == b or bool(a and b) and len(a & b) >= 0.8 * len(a | b) - 1e-9
    n = len(rows)
    near = [[j for j in range(n) if j != i and linked(sets[i], sets[j])] for i in range(n)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in near[i]:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    members = {}
    for i in range(n):
        members.setdefault(find(i), []).append(i)
    out = []
    for i in range(n):
        group = members[find(i)]
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(group), len(near[i]),
                    len({sets[j] for j in near[i]} - {sets[i]})))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(900)] + ["Élan", "naïve", "THE", "the"]
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = []
    for _ in range(25):
        base = fresh(rng.choice([7, 40, 90, 300]))
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w))
    hub = fresh(150)
    for _ in range(60):  # a family of many different near copies
        w = list(hub)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append(rng.choice([" ", "\n"]).join(w))
    rows += ["", None, " \t", "one two", "One two", "one two three four", "a b c d e", "A  b c\nd e"]
    rng.shuffle(rows)
    out = [(1000 - i, t) for i, t in enumerate(rows)]
    return out + [(None, rows[0]), (None, "alone and without an id here"), out[5], out[5], (1000, rows[3])]


@pytest.mark.parametrize("block", [256, 8])
def test_classes_and_links_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(6)
    got = sorted((tuple(r)[:5] for r in near_classes(docs).collect()), key=str)
    assert got == reference(rows)


def test_one_document_of_each_class_stays(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(near_join, "BROADCAST_NODES", 0)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    out = one_of_each_class(docs)
    assert out.columns == docs.columns
    sets = [shingles(t) for _, t in rows]
    classes = {}  # any two rows of a class share its id and size; tell classes of null ids by their sets
    for r in near_classes(docs).collect():
        classes[bytes(r.root)] = r.class_id
    got = out.collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(classes.values(), key=str)
    left = [shingles(r.text) for r in got]
    assert len(set(left)) == len(left) and set(left) <= set(sets)
    assert one_of_each_class(docs.limit(0)).count() == 0 and near_classes(docs.limit(0)).count() == 0


def test_banding_meets_its_target():
    bands, rows = banding(0.8, 0.999, 160)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 and bands * rows <= 160
    with pytest.raises(ValueError):
        banding(0.1, 0.99999, 4)


def test_sets_ignore_batch_neighbours():
    texts = [b"a b c d e f", b"", b"x", b"a b c d e f", ("wort " * 5000).encode()]
    alone = [ngram_sets([t])[0] for t in texts]
    for a, b in zip(alone, ngram_sets(texts), strict=True):
        assert np.array_equal(a, b)
    assert [len(a) for a in alone] == [2, 0, 1, 2, 1]


def test_null_and_repeated_ids_do_not_multiply(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        w = list(base)
        w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = [(None if i % 3 else 7, t) for i, t in enumerate(texts)] + [(None, texts[0])] * 200
    cut, plain = [], near_join.stored

    def counted(df, name, **options):
        out = plain(df, name, **options)
        if name == "near-plan":
            cut.append(out.count())
        return out
    monkeypatch.setattr(near_join, "stored", counted)
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.class_id, r.class_size, r.n_links, r.n_text_links) for r in near_classes(docs).collect()), key=str)
    assert got == reference(rows)
    assert cut == [150]
