import random
import re

import pytest

from pulsevault.llm.queries import ORACLE, QUERIES
from pulsevault.llm.url_reputation import RULES, domain_of, host_reputation, judged, page_outcomes, suffix_of

PAGES = "page_id long, url string, host string, rule string, n long"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "example.net/en/", "http://EXAMPLE.net/en/x", "https://a.b.example.net/en/", "http://example.net/en", "http://example.net?x=/en/",
        "http://example.net", "http://net/", "http://fornet/", "http://x.example.com/de/1?y#z", "http://example.com/de", "ftp://h.org/fr/#/de/",
        "http://h.org/FR/", "://org/fr/", "http://a://b/c", "http://example.com:80/de/", "http:///x", "http://üÄ.org/fr/é\nü?q", "http://x.net//", "a\nb://Q.org/fr/"]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(URLS)]
    none = spark.createDataFrame([], "url string, bad double")
    got = {r.page_id: r for r in judged(spark.createDataFrame(rows, PAGES), none).collect()}
    for i, u in enumerate(URLS):
        host, path = split(u)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow"), u
    assert judged(spark.createDataFrame([], PAGES), none).count() == 0


def test_reputation_blocks_bad_hosts_and_shrinks_small_ones(spark):
    rng = random.Random(1)
    outcomes = [(f"http://h{h}.d{h % 5}.org/{i}", float(rng.random() < (.95 if h == 3 else .1))) for h in range(30) for i in range(60)]
    outcomes += [("http://one.d0.org/1", 1.0)]
    pages = [(i, u, "x", "y", 1) for i, (u, _) in enumerate(outcomes)] + [(9000, "http://new.d3.org/", "x", "y", 1), (9001, "http://one.d0.org/2", "x", "y", 1)]
    table = spark.createDataFrame(pages, PAGES).repartition(4)
    got = {r.host: r for r in judged(table, spark.createDataFrame(outcomes, "url string, bad double")).collect()}
    assert {h for h, r in got.items() if r.verdict == "block"} == {"h3.d3.org"}
    assert got["one.d0.org"].rate < .5 < got["h3.d3.org"].low < got["h3.d3.org"].rate


def test_without_broadcast_and_with_odd_outcomes(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.org/1", "x", "y", 1), (1, "http://a.org/1", "x", "y", 1), (None, "http://b.org/2", "x", "y", 1)], PAGES)
    seen = spark.createDataFrame([("http://a.org/1", None), (None, 1.0), ("http://a.org/1", 1.0)], "url string, bad double")
    wide = judged(pages, seen).collect()
    monkeypatch.setattr("pulsevault.llm.url_reputation.BROADCAST_HOSTS", 0)
    assert sorted(map(str, judged(pages, seen).collect())) == sorted(map(str, wide)) and len(wide) == 3


def test_domains(spark):
    rows = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "x.y.com", "y.com", "com", "")], "h string")
    got = {r.h: (r.d, r.s) for r in rows.select("h", domain_of(rows["h"]).alias("d"), suffix_of(rows["h"]).alias("s")).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "y.com": ("y.com", "com"),
                   "com": ("com", "com"), "": ("", "")}


def test_outcomes_come_from_the_document_in_the_path(spark):
    pages = spark.createDataFrame([(1, "http://a/en/7?x", "x", "y", 1), (2, "http://a/en/8", "x", "y", 1), (3, "http://a/9x", "x", "y", 1), (4, None, "x", "y", 1),
                                   (5, "http://a/99999999999999999999999", "x", "y", 1)], PAGES)
    labels = spark.createDataFrame([(7, 0, 0), (7, 1, 0), (8, 1, 1), (9, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, page_outcomes(pages, labels).collect())) == [("http://a/en/7?x", .5), ("http://a/en/8", 1.0)]


def test_outcomes_of_paths_with_an_extension(spark):
    paths = ["/en/7.html", "/en/8.htm/", "/7.php5?x#y", "/7.html.", "/a7.html", "/7.1", "/7.", "/html", "/7.html/x"]
    pages = spark.createDataFrame([(i, "http://a" + p, "x", "y", 1) for i, p in enumerate(paths)], PAGES)
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, page_outcomes(pages, labels).collect())) == [("http://a/7.php5?x#y", 1.0), ("http://a/en/7.html", 1.0), ("http://a/en/8.htm/", 0.0)]


def test_posterior_follows_the_counts(spark):
    outcomes = spark.createDataFrame([("a.org", 1.0)] * 50 + [("b.org", 0.0)] * 50, "host string, bad double")
    got = {r.host: r for r in host_reputation(outcomes, outcomes.select("host")).collect()}
    assert got["a.org"].rate > .9 and got["b.org"].rate < .1 and got["a.org"].n == 50


@pytest.mark.parametrize("key", ["op7_url_reputation", "op8_mixing", "op9_exact_dedup"])
def test_oracles_on_given_tables(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    want = con.execute(ORACLE[key])
    names = [d[0] for d in want.description]
    got = sorted((tuple(r) for r in QUERIES[key](spark, "/root/testdata/sf0.01").select(*names).collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)
