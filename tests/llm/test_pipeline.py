import hashlib

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from pulsevault.llm.bpe import encoder
from pulsevault.llm.common import table
from pulsevault.llm.line_quality import quality_scores
from pulsevault.llm.queries import VOCABULARY

from test_mixing import reference as mixed_words
from test_near_join import reference as near_classes

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_plain_stages(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r.doc_id for r in quality_scores(docs, labels).filter("score >= 0.5").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    assert 0 < len(rows) < docs.count()
    last = {}
    for i, t, _ in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = [r for r in rows if last[r[1] or ""] == r[0]]
    classes = near_classes([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if r[0] in {c for _, c, *_ in classes}]
    _, taken = mixed_words(rows)
    tokens = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder(P.path(VOCABULARY)).ranks, special_tokens={})
    want = []
    for i, t, s in rows:
        n = len((t or "").split())
        ids = tokens.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for _ in range(taken.get((i, s), 0) // n if n else 0):
            want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect() if r.n_tokens]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = table(spark, SF, "documents")
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_stages_keep_columns_with_clashing_names(spark):
    """Extra columns that have the names the stages use inside, or odd ones."""
    names = ["__score", "__id", "__hash", "__own_hash", "__sha", "__stays", "__own_sha", "__mix_id", "__mix_text", "kept", "node", "size", "a.b", "t"]
    docs = table(spark, SF, "documents")
    wide = docs.toDF(*docs.columns)
    for i, name in enumerate(names):
        wide = wide.withColumn(name, wide["doc_id"] * 100 + i)
    wide = wide.unionByName(wide.filter("doc_id < 20")).unionByName(wide.filter("doc_id = 3").withColumn("text", F.lit(None).cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        plain = stage(spark, wide.select(*docs.columns), SF)
        assert out.dtypes == wide.dtypes, name
        rows = out.collect()
        assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id, r.text or "") for r in plain.collect()), name
        assert all(r[len(docs.columns) + i] == r.doc_id * 100 + i for r in rows for i in range(len(names))), name
    digests = corpus_pipeline.STAGES[-1][1](spark, wide, SF)
    assert digests.count() == wide.count()
