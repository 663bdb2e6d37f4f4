import hashlib
import random
import re
import string

import duckdb
import pytest

from pulsevault.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def plain(docs, items, window=10):
    """Row by row: every window of every item against every position."""
    patterns = []
    for item, text in items:
        w = words(text)
        if w:
            patterns += [(w[k:k + window], "" if item is None else str(item)) for k in range(max(len(w) - window + 1, 1))]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, names = set(), set()
        for p, name in patterns:
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    names.add(name)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def made(seed, n_docs=60, n_items=30):
    """Documents and items over few words, so that windows overlap, repeat and nearly occur."""
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "of", "Zebra", "x1", "éa", "漢字", "longerword", "averyveryverylongwordindeed"]
    some = lambda n: rng.choice([" ", ", ", "-\n", "\x00"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 15, 40]) if i % 6 == 0 else rng.randint(10, 30))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        text = some(rng.randint(0, 60))
        if rng.random() < 0.7:
            w = rng.choice(items)[1]
            cut = rng.randint(0, max(len(w) - 1, 0))
            text = text + rng.choice(["", " ", "!"]) + w[cut:] + rng.choice([" ", "", "q"]) + some(rng.randint(0, 20))
        docs.append((i, text))
    return docs, items


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("limit", [7, D.TABLE_WINDOWS])
def test_tables_find_what_plain_search_finds(seed, limit):
    docs, items = made(seed)
    want = {d[0]: d for d in plain(docs, items)}
    spans, names = {}, {}
    for table in D.pattern_tables([(str(i), t.encode()) for i, t in items], limit=limit):
        for (doc, _), (n, runs, found) in zip(docs, table.search([t.encode() for _, t in docs]), strict=True):
            assert n == want[doc][1]
            spans.setdefault(doc, set()).update(p for a, z in runs for p in range(a, z))
            names.setdefault(doc, set()).update(found)
    assert {d: (len(spans[d]), len(names[d])) for d in spans} == {d: w[2:4] for d, w in want.items()}


def test_query_over_odd_rows(spark, monkeypatch):
    docs, items = made(9)
    docs += [(None, None), (None, ""), (3, docs[3][1]), (None, items[1][1]), (None, items[1][1]), (70, " \n"), (71, "x " * 30_000 + items[2][1])]
    items += [(None, "one two three four five six seven eight nine ten eleven"), (4, "again the fourth"), (90, None), (91, "...")]
    docs.append((72, "zero One two-three four five six seven eight nine TEN"))
    want = sorted(plain(docs, items), key=str)
    d = spark.createDataFrame([(a, b, "x") for a, b in docs], DOCS + ", h string")
    i = spark.createDataFrame([(a, b, 1) for a, b in items], ITEMS + ", name int")
    assert rows(D.contamination(d, i)) == want
    monkeypatch.setattr(D, "BLOCK_BYTES", 700)  # several blocks: the merged passes
    assert rows(D.contamination(d, i)) == want


def test_empty_tables(spark):
    docs, items = made(1, 5, 5)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert D.contamination(d.limit(0), i).count() == 0
    assert rows(D.contamination(d, i.limit(0))) == sorted(plain(docs, []), key=str)


def test_long_text_and_many_equal_windows():
    passage = " ".join(f"w{i}" for i in range(40))
    table = next(D.pattern_tables([("1", passage.encode()), ("2", passage.encode()), ("3", b"hot hot hot hot hot hot hot hot hot hot hot")]))
    filler = "lorem ipsum dolor sit amet " * 200_000
    text = (filler + passage + " " + filler + "hot " * 5000).encode()
    n, runs, names = table.search([text])[0]
    assert n == 2_005_040 - 0 and names == ["1", "2", "3"]
    assert runs == [(1_000_000, 1_000_040), (2_000_040, 2_005_040)]


def test_given_tables_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({D.SQL})").fetchall(), key=str)
    table = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    got = rows(D.contamination(table("documents"), table("benchmark")).select(*names))
    assert got == want
    assert sum(r[5] for r in got) > 0
