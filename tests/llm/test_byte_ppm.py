import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulsevault.llm import byte_ppm
from pulsevault.llm.byte_ppm import MARK, Lookup, ladder, log_probabilities, packed, scored, text_tokens

SCHEMA = "doc_id long, text string, t string, score double, block int"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


class PlainModel:
    """The model by its definition, with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            for context, byte in self.steps(t):
                self.counts[order][context][byte] += 1
        for k in range(order - 1, -1, -1):
            for context, following in self.counts[k + 1].items():
                for byte in following:
                    self.counts[k][context[1:]][byte] += 1

    def steps(self, text):
        data = bytes([MARK]) * self.order + lowered(text).encode() + bytes([MARK])
        for i in range(self.order, len(data)):
            yield data[i - self.order:i], data[i]

    def probability(self, context, byte):
        p, gone = 1.0, set()
        for k in range(self.order, -1, -1):
            following = {b: c for b, c in self.counts[k].get(context[self.order - k:], {}).items() if b not in gone}
            n, q = sum(following.values()), len(following)
            if n:
                if byte in following:
                    return p * (2 * following[byte] - 1) / (2 * n)
                p *= q / (2 * n)
            gone |= set(following)
        return p / (256 - len(gone))

    def score(self, text):
        return sum(math.log10(self.probability(c, b)) for c, b in self.steps(text))


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "Then", "ether", "où", "été", "a", "漢字", "tether", "ant\n", "!", "x" * 30]
    rows = [(i, rng.choice([None, "", " "]) if rng.random() < .05 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(n)]
    return rows + [rows[3], rows[3], (None, "the ether"), (n + 1, "zq" * 2000)]


def test_scores_match_the_definition(spark):
    rows = corpus(1, 150)
    docs = spark.createDataFrame([(i, t, "x", .5, 1) for i, t in rows], SCHEMA).repartition(6)
    trained = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0]
    model = PlainModel(trained, 5)
    split = lambda t: [w for w in lowered(t).replace("\n", " ").split(" ") if w] + ["<end>"]
    counts = Counter(w for t in trained for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((("" if i is None else str(i)), zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(split(t)),
                   sum(counts[w] > 0 for w in split(t)), n, sum(math.log10((counts[w] + .1) / (n + .1 * (v + 1))) for w in split(t)),
                   model.score(t)) for i, t in rows)
    got = sorted((("" if r.doc_id is None else str(r.doc_id)), *r[1:]) for r in scored(docs).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_files_as_blocks_give_the_same_scores(spark, tmp_path):
    rows = corpus(2, 120)
    docs = spark.createDataFrame([(i, t, "x", .5, 1) for i, t in rows], SCHEMA)
    docs.repartition(5).write.parquet(f"file://{tmp_path}/d")
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.score, 6), round(r.base_score, 6))
    assert sorted(map(key, scored(docs).collect())) == sorted(map(key, scored(spark.read.parquet(f"file://{tmp_path}/d")).collect()))


@pytest.mark.parametrize("files", [True, False])
def test_many_blocks_and_context_groups_give_the_same_scores(spark, tmp_path, monkeypatch, files):
    rows = corpus(7, 120) * 2
    docs = spark.createDataFrame([(i, t, "x", .5, 1) for i, t in rows], SCHEMA)
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.score, 6), round(r.base_score, 6))
    want = sorted(map(key, scored(docs).collect()))
    if files:
        docs.repartition(3).write.parquet(f"file://{tmp_path}/d")
        docs = spark.read.parquet(f"file://{tmp_path}/d")
    monkeypatch.setattr(byte_ppm, "BLOCK_BYTES", 500)
    monkeypatch.setattr(byte_ppm, "GROUP_PAIRS", 20)
    assert sorted(map(key, scored(docs).collect())) == want


def test_probabilities_of_a_context_add_up_to_one():
    pairs, _ = packed([t.encode() for _, t in corpus(3, 60) if t], 5)
    keys, n = np.unique(pairs, return_counts=True)
    tries = ladder(keys, n.astype(np.int64), 5, 0)
    for key in [*keys[::97], np.uint64(0x0102030405 << 8), np.uint64((0x01020304 << 16) | (ord("e") << 8))]:
        every = (key >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert np.exp(log_probabilities(tries, every)).sum() == pytest.approx(1)


def test_without_training_texts_and_without_rows(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row, = scored(spark.createDataFrame([(held, "ab", "x", .5, 1)], SCHEMA)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (2, 0, 0) and row.score == pytest.approx(-3 * math.log10(256))
    assert scored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_text_ends_do_not_touch():
    alone = [packed([t])[0].tolist() for t in (b"ab", b"", b"c")]
    both, edges = packed([b"ab", b"", b"c"])
    assert [both[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == alone
    tokens, edges = text_tokens([b"a b", b"", b" c"])
    assert edges.tolist() == [0, 3, 4, 6]


def test_lookups_find_every_key_and_no_other():
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate((rng.integers(0, 2**63, 5000, dtype=np.uint64), np.arange(300, dtype=np.uint64))))
    table = Lookup(keys, np.arange(len(keys), dtype=float))
    asked = rng.choice(keys, 20_000)
    assert np.array_equal(table(asked), np.searchsorted(keys, asked))
    with pytest.raises(RuntimeError):
        Lookup(keys[1:], np.zeros(len(keys) - 1))(keys[:1])
