import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from pulsevault.llm import bpe
from pulsevault.llm.bpe import PrefixEncoder, decode, encode, encoder, splitter, token_digests

VOCABULARY = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens long"
ALPHABET = "abcdefgh ÄÖßé漢字🙂​ \x00\n\t '123.,!?THEthe"


@pytest.fixture(scope="module")
def enc():
    return encoder(VOCABULARY)


@pytest.fixture(scope="module")
def reference(enc):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


def some_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_pieces_match_the_library(enc, reference):
    for text in some_texts(1, 1500):
        assert [i for p in splitter(P.PATTERN)(text) for i in enc.encode_piece(p.encode())] == reference.encode_ordinary(text)


def test_prefixes_on_demand_and_the_whole_table_agree(enc):
    for text in [*some_texts(2, 800), "x" * 1000, " aAbB" * 100]:
        data = text.encode()
        assert enc.encode_bytes(data) == enc.read(enc.extend(data, enc.table()))


def test_entries_that_merges_never_reach_are_whole_pieces_only():
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258, b"abcd": 259}
    enc = PrefixEncoder(ranks)
    plain = tiktoken.Encoding("own", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for _ in range(500):
        s = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        assert enc.encode_piece(s.encode()) == plain.encode_ordinary(s)


def test_appends_are_exact_and_cost_the_new_bytes(enc):
    rng = random.Random(4)
    for text in some_texts(5, 100):
        data = text.encode()
        cut = rng.randint(0, len(data))
        table = enc.extend(data[:cut], enc.table())
        assert enc.read(enc.append(table, data[:cut], data[cut:])) == enc.encode_bytes(data)


def test_edits_work_near_the_edit_only(enc):
    rng = random.Random(6)
    for _ in range(60):
        old = "".join(rng.choice(ALPHABET) for _ in range(600)).encode()
        at, removed, inserted = rng.randint(0, 500), rng.randint(0, 5), bytes(rng.randrange(256) for _ in range(rng.randint(0, 5)))
        table, worked = enc.edit(enc.extend(old, enc.table()), old, at, removed, inserted)
        new = old[:at] + inserted + old[at + removed:]
        fresh = enc.extend(new, enc.table())
        assert table.last == fresh.last and [[(k, id(f)) for k, f in s] for s in table.alive] == [[(k, id(f)) for k, f in s] for s in fresh.alive]
        assert worked <= len(inserted) + 2 * enc.longest + 2 or worked <= len(new) - at


def test_digests_of_a_table(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    rows = [(i, t) for i, t in enumerate(some_texts(7, 200))] + [(None, None), (3, ""), (3, ""), (900, "naïve  " * 20_000)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA).repartition(3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, token_digests(docs, VOCABULARY, P.PATTERN).collect()), key=str) == sorted(want, key=str)
    assert token_digests(docs.limit(0), VOCABULARY, P.PATTERN).count() == 0


def test_round_trip(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(some_texts(8, 100))] + [(1000, None, "x", 0)]
    back = decode(encode(spark.createDataFrame(rows, SCHEMA), VOCABULARY, P.PATTERN), VOCABULARY)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == {i: t or "" for i, t, *_ in rows}


def test_texts_in_stretches_and_pieces_that_are_not_remembered(enc, reference, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 7)
    monkeypatch.setattr(bpe, "_LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 2000)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    texts = [*some_texts(9, 60), "", "a", "abc" * 5000, " the cat" * 300, "é" * 999]
    for text, got in zip(texts, bpe._digests(texts, enc, P.PATTERN), strict=True):
        ids = reference.encode_ordinary(text)
        assert got == (len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode()))
    assert max(map(len, enc._pieces)) <= 200


@pytest.mark.parametrize("text", ["x" * (1 << 20), "word and word, " * (20 << 16)])
def test_memory_of_very_long_texts_follows_their_bytes(enc, text):
    """A piece of 1 MB, and a text of 20 MB."""
    import tracemalloc
    sha = lambda b: hashlib.sha256(b).hexdigest()
    tracemalloc.start()
    (n, _, decoded), = bpe._digests([text], enc, P.PATTERN)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 0 and decoded == sha(text.encode()) and peak < 100e6 + 8 * len(text)


def test_remembered_pieces_are_bounded_by_what_they_take(monkeypatch):
    from sys import getsizeof
    monkeypatch.setattr(bpe, "MEMO_BYTES", 1 << 20)
    enc = bpe.PrefixEncoder(bpe.encoder(VOCABULARY).ranks)
    for at in range(0, 20_000, 500):
        list(enc.ids_of([[f"x{i}y" for i in range(at, at + 500)]]))
    held = [d for d in vars(enc).values() if isinstance(d, dict) and "x19999y" in d or isinstance(d, dict) and "x17800y" in d]
    assert held and sum(getsizeof(d) + sum(getsizeof(k) + getsizeof(v) for k, v in d.items()) for d in held) <= 1.3 * (1 << 20)
    assert "trie" not in vars(enc)  # only long pieces are read forwards
