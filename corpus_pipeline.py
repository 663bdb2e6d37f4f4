"""The corpus pipeline over ``documents``.

1. quality classifier: documents that the line field scores below 0.5 go;
2. exact dedup: of equal texts one stays;
3. n-gram Jaccard join: one document of each class of near copies stays;
4. mixing sources to target weights: documents repeat or go as the mix decides;
5. byte-level BPE: token counts and digests of what is left.

Every stage reads the stored result of the one before and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers

from pulsevault.llm import bpe, exact_dedup, line_quality, mixing, near_join
from pulsevault.llm.common import stored, table
from pulsevault.llm.queries import VOCABULARY


def quality(spark, docs, sf_dir):
    """Documents with a quality score of 0.5 or more, the field being fitted to the labelled ones."""
    return line_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark, docs, sf_dir):
    """One row of each class of near copies."""
    return near_join.one_of_each_class(docs)


def mixed(spark, docs, sf_dir):
    """Every row as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark, docs, sf_dir):
    """Token digests of every row."""
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]
#: The classifier is fitted in Python; tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``, each over the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
