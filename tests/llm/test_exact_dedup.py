import hashlib
import random

import pytest

from pulsevault.llm.exact_dedup import drop_exact_copies, exact_groups

SCHEMA = "doc_id long, text string, sha string, keep_id long, n long"


def reference(rows):
    """Multiset of (doc_id, keep_id, group_size, kept, sha) by brute force."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, stays = max(known) if known else None, True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and stays, hashlib.sha256(t.encode()).hexdigest()))
            stays = stays and i != keep
    return sorted(out, key=str)


def rows_of(seed):
    rng = random.Random(seed)
    texts = ["", "a", "b", "aa", "ab" * 300, "ab" * 299 + "ba", "é" * 200, "x" * 100_000, None, "x" * 99_999 + "y"]
    return [(rng.choice([None, *range(60)]) if rng.random() < .3 else 100 + k, rng.choice(texts) if rng.random() < .6 else f"t{k}") for k in range(300)]


def test_groups_match_brute_force(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA).repartition(7)
    got = sorted((tuple(r) for r in exact_groups(docs, digest_all=True).collect()), key=str)
    assert got == reference(rows)


def test_without_broadcast_the_result_is_the_same(spark, monkeypatch):
    rows = rows_of(2)
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA)
    monkeypatch.setattr("pulsevault.llm.exact_dedup.BROADCAST_KEYS", 0)
    assert sorted((tuple(r) for r in exact_groups(docs, digest_all=True).collect()), key=str) == reference(rows)


def test_unique_rows_are_never_hashed_in_full(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "abd"), (3, "zzzz"), (4, "abc")], "doc_id long, text string")
    got = {r.doc_id: r for r in exact_groups(docs).collect()}
    assert got[3].text_sha256 is None and got[2].text_sha256 is None and got[1].text_sha256 == got[4].text_sha256
    assert (got[1].kept, got[4].kept, got[3].kept) == (False, True, True)


def test_any_number_of_bits_gives_the_same_rows(spark, monkeypatch):
    """With one block of bits nearly every row is hashed in full, and no result changes."""
    rows = rows_of(5)
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA)
    monkeypatch.setattr("pulsevault.llm.exact_dedup.FILTER_BITS", 16)
    assert sorted((tuple(r) for r in exact_groups(docs, digest_all=True).collect()), key=str) == reference(rows)
    assert drop_exact_copies(docs).count() == sum(r[3] for r in reference(rows))


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a", 1, 2, 3, 4), (2, "a", 5, 6, 7, 8), (3, "b", 9, 9, 9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __block int, __bits int, __own_sha int, __length int")
    assert sorted(tuple(r) for r in drop_exact_copies(docs).collect()) == rows[1:]


@pytest.mark.parametrize("keys", [0, 500_000])
def test_dropped_rows(spark, keys, monkeypatch):
    monkeypatch.setattr("pulsevault.llm.exact_dedup.BROADCAST_KEYS", keys)
    rows = rows_of(3)
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA)
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    want = sorted(((i, t) for i, _, _, kept, t in reference(rows) if kept), key=str)
    assert sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=str) == want
    assert drop_exact_copies(docs.limit(0)).count() == 0 and exact_groups(docs.limit(0)).count() == 0


def test_repeated_ids_without_all_digests(spark):
    rows = rows_of(4) + [(500, "one text"), (500, "another text, as unique"), (None, "third"), (None, "a fourth text")]
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA).repartition(5)
    key = lambda r: (r[0], r[1], r[2], r[3])
    got = sorted((key(r) for r in exact_groups(docs, digest_all=False).collect()), key=str)
    assert got == sorted(map(key, reference(rows)), key=str)
