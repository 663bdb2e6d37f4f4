"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from pulsevault.llm import (
    ann_graph, bpe, byte_ppm, decontaminate, exact_dedup, line_quality, mixing, near_join, toxic_passages, turn_repair, url_reputation,
    whitening, wrapper,
)
from pulsevault.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_wrapper_induction(spark, sf_dir):
    """Main text of every page."""
    return wrapper.extracted(table(spark, sf_dir, "pages"))


def op2_nn_descent(spark, sf_dir):
    """The 5 nearest other vectors of every 50th vector."""
    return ann_graph.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op3_line_quality(spark, sf_dir):
    """Quality score of every document."""
    return line_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark, sf_dir):
    """Near-duplicate class and number of links of every document."""
    return near_join.near_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "n_links", "n_text_links")


def op5_toxic_passages(spark, sf_dir):
    """Toxicity score of every document."""
    return toxic_passages.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_ppm(spark, sf_dir):
    """Language-model score of every document."""
    return byte_ppm.scored(table(spark, sf_dir, "documents"))


def op7_url_reputation(spark, sf_dir):
    """Verdict on every page's url, with its host's posterior rate of bad pages and the bound."""
    pages = table(spark, sf_dir, "pages")
    outcomes = url_reputation.page_outcomes(pages, table(spark, sf_dir, "labels"))
    return url_reputation.judged(pages, outcomes).select(
        "page_id", "host", "path", "rule", "verdict", F.round("rate", 6).alias("rate"), F.round("low", 6).alias("low"))


def op8_mixing(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark, sf_dir):
    """Every row of ``documents`` with its group of equal texts."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)


def op10_byte_bpe(spark, sf_dir):
    """Token digests of every document."""
    docs = table(spark, sf_dir, "documents")
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op11_decontamination(spark, sf_dir):
    """Hit words and benchmark items of every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_turn_repair(spark, sf_dir):
    """Audit and digest of every conversation's repair."""
    return turn_repair.repair_audits(turn_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_whitening(spark, sf_dir):
    """The first 8 whitened components of every vector."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_wrapper_induction, op2_nn_descent, op3_line_quality, op4_ngram_join, op5_toxic_passages, op6_byte_ppm,
    op7_url_reputation, op8_mixing, op9_exact_dedup, op10_byte_bpe, op11_decontamination,
    op12_turn_repair, op13_whitening,
)}
ORACLE = {
    "op7_url_reputation": url_reputation.SQL, "op8_mixing": mixing.SQL, "op9_exact_dedup": exact_dedup.SQL,
    "op11_decontamination": decontaminate.SQL,
}
