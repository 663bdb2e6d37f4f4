"""Toxic passages by maximum-scoring segments over token log-odds.

Learning (a bounded sample of labelled documents, ``FIT_DOCS``): token counts of toxic and of other
documents, a token counting once per document, are smoothed with a Dirichlet prior in proportion to their
pooled counts. The excess of the
toxic over the clean frequencies, of tokens whose log-odds are significant (z of ``MIN_Z``), is the
lexicon's distribution t; a toxic passage is modelled as ``DENSITY`` parts of t and the rest ordinary
text p. A token's score is the log-likelihood ratio log((1 - d) + d t/p): positive for the lexicon, the
same small negative number for all else, so the expected score of ordinary text is negative.

Scoring: one linear scan per text keeps the list of disjoint candidate segments and joins them while
that raises a segment's score, which finds every maximal segment. Their scores follow an extreme-value
law: a segment of score S in a text of n tokens has E-value K n exp(-lambda S); lambda solves
sum p exp(lambda s) = 1 over ordinary tokens and K is counted on the clean documents of the sample. A
document's features are the log E-value of its best segment and the summed excess of all significant
ones; a logistic curve fitted to the sample gives the score.

Tokens are runs of anything but ASCII white space and punctuation, A-Z lower-cased. The lexicon (bounded by the
sample's tokens) is broadcast with the scoring function; texts are never shuffled.

Defined results: a null text equals the empty text, which has no segment and the lowest score; a null or
missing label is no label; an id labelled several times counts as toxic if its mean label is 0.5 or more;
without labels of both kinds every score is 0; repeated rows are scored each; an empty table gives an empty
table; only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import crc_mod, executors_ready, stored, text_chunks, text_of
from pulsevault.llm.line_quality import labelled_sample
from pulsevault.llm.words import joined, mixed, token_hashes

FIT_DOCS = 12_000
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Weight of the Dirichlet prior, as a share of the counted tokens.
PRIOR = 0.02
MIN_Z = 2.6
DENSITY = 0.1
#: Segments below this E-value are significant.
MAX_E = 0.05


def maximal_segments(scores: np.ndarray, positions: np.ndarray, step: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last position, score) of a sequence whose tokens at ``positions``
    score ``scores`` and all others ``step`` (negative). Each candidate keeps the cumulative score before
    it and at its end; a new positive token takes in earlier candidates while the sum before the nearest
    one with a lower start is exceeded by the new end. Work is linear in the positive tokens."""
    found: list[list] = []  # first, last, sum before, sum at end, index of nearest earlier one with a lower start
    total, done = 0.0, 0
    for at, score in zip(positions.tolist(), scores.tolist(), strict=True):
        total += step * (at - done)
        done = at + 1
        before, total = total, total + score
        if score <= 0:
            continue
        new = [at, at, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], at, found[j][2], total]
            del found[j:]
    return [(a, b, end - start) for a, b, start, end, _ in found]


@dataclass
class PassageModel:
    """Token scores, extreme-value law and curve."""

    tokens: np.ndarray  # sorted hashes of the lexicon
    scores: np.ndarray
    step: float
    rate: float = 1.0  # lambda
    k: float = 1.0
    curve: np.ndarray | None = None

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.tokens):
            return np.zeros(0, np.int64), np.zeros(0)
        i = np.searchsorted(self.tokens, hashes)
        i[i == len(self.tokens)] = 0
        at = np.flatnonzero(self.tokens[i] == hashes)
        return at, self.scores[i[at]]

    def segments(self, texts: list[bytes]):
        """Per text: (number of tokens, [(first byte, end byte, score)] of the maximal segments)."""
        data, bounds = joined(texts)
        hashes, starts, ends = token_hashes(data)
        at, scores = self._known(hashes)
        edge = np.searchsorted(starts, bounds)
        known = np.searchsorted(at, edge)
        for t in range(len(texts)):
            a, b = known[t], known[t + 1]
            first, n = edge[t], int(edge[t + 1] - edge[t])
            found = maximal_segments(scores[a:b], at[a:b] - first, self.step) if b > a else []
            yield n, [(int(starts[first + i] - bounds[t]), int(ends[first + j] - bounds[t]), s) for i, j, s in found]

    def e_value(self, n: int, score: float) -> float:
        """Expected number of segments of at least this score in ``n`` ordinary tokens."""
        return self.k * max(n, 1) * float(np.exp(-min(self.rate * score, 600)))

    def features(self, texts: list[bytes]) -> np.ndarray:
        """(minus log E-value of the best segment, summed minus log E-values of the significant ones), per text."""
        out = np.zeros((len(texts), 2))
        for i, (n, found) in enumerate(self.segments(texts)):
            logs = [-np.log(self.e_value(n, s)) for _, _, s in found]
            out[i, 0] = max(logs, default=-np.log(self.k * max(n, 1)) if n else -20.0)
            out[i, 1] = sum(v for v in logs if v > -np.log(MAX_E))
        return np.clip(out, -20, 60) / 10

    def document_scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of each text."""
        if self.curve is None:
            return np.zeros(len(texts))
        z = self.features(texts) @ self.curve[1:] + self.curve[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _lexicon(hashes: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> PassageModel:
    """Scores from the counts of each token in toxic and clean documents."""
    a, b = toxic + PRIOR * (toxic + clean), clean + PRIOR * (toxic + clean)
    n_a, n_b = a.sum(), b.sum()
    odds = np.log(a / (n_a - a)) - np.log(b / (n_b - b))
    z = odds / np.sqrt(1 / a + 1 / b)
    excess = np.maximum(a / n_a - b / n_b, 0)
    use = z >= MIN_Z
    order = np.argsort(hashes[use])
    t, p = (excess[use] / max(excess[use].sum(), 1e-300))[order], (b[use] / n_b)[order]
    scores = np.log((1 - DENSITY) + DENSITY * t / p)
    model = PassageModel(hashes[use][order], scores, float(np.log(1 - DENSITY)))
    rest = max(1 - p.sum(), 1e-9)
    total = lambda lam: (p * np.exp(np.minimum(lam * scores, 600))).sum() + rest * np.exp(lam * model.step) - 1
    low, high = 1e-3, 1.0
    while total(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 0 else (low, mid)
    model.rate = high
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w += np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
    return w


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           fit_docs: int = FIT_DOCS, folds: int = FOLDS, held_out: int = HELD_OUT) -> PassageModel:
    """The model fitted to at most ``fit_docs`` labelled documents outside the held-out fold. Token counts are
    summed per task and then per token by Spark; the lexicon and two numbers per document come back. Every
    third document of the sample counts no tokens and fits the curve and K only."""
    executors_ready(docs.sparkSession)
    ids = labelled_sample(labels, id_col, label_col, fit_docs, folds, held_out)
    curve = (F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit(5)), F.lit(3)) == 0).alias("curve")
    rows = docs.select(docs[id_col].alias("__id"), text_of(docs, text_col).alias("__text"))
    rows = stored(rows.join(F.broadcast(ids), "__id").select("__label", curve, "__text"), "toxic-sample")

    def count(batches):
        for b, texts in text_chunks(batches, 1):
            data, bounds = joined(texts)
            hashes, starts, _ = token_hashes(data)
            text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, bounds)))
            _, first = np.unique(hashes ^ mixed(text.astype(np.uint64)), return_index=True)  # once per document
            toxic = b.column(0).to_numpy(zero_copy_only=False)[text[first]]
            token, back = np.unique(hashes[first], return_inverse=True)
            n, pos = np.bincount(back), np.bincount(back, toxic)
            yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(pos.astype(np.int64)), pa.array((n - pos).astype(np.int64))],
                                             names=["token", "toxic", "clean"])

    counts = rows.filter("not curve").select("__label", "__text").mapInArrow(count, "token long, toxic long, clean long")
    counts = counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = stored(counts, "toxic-tokens")
    sums = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not sums["t"] or not sums["c"]:
        return PassageModel(np.zeros(0, np.uint64), np.zeros(0), -0.1)
    # only tokens above their share in toxic documents can enter the lexicon; the rest count in one sum
    above = F.col("toxic") * F.lit(float(sums["c"])) > F.col("clean") * F.lit(float(sums["t"]))
    pdf = counts.filter(above & (F.col("toxic") >= 3)).orderBy("token").toPandas()
    rest = [sums["t"] - pdf.toxic.sum(), sums["c"] - pdf.clean.sum()]
    hashes = np.append(pdf.token.to_numpy(np.int64).astype(np.uint64), np.uint64(0))
    model = _lexicon(hashes, np.append(pdf.toxic.to_numpy(float), rest[0]), np.append(pdf.clean.to_numpy(float), rest[1]))

    def measured(features: bool):
        def run(batches):
            for b, texts in text_chunks(batches, 1):
                if features:
                    x = model.features(texts)
                else:  # segments of score 3 and more, and tokens
                    x = np.array([[sum(s >= 3 for *_, s in found), n] for n, found in model.segments(texts)], float)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["label", "a", "b"])
        return rows.filter("curve").select("__label", "__text").mapInArrow(run, "label int, a double, b double")

    clean = measured(False).filter("label = 0").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    model.k = ((clean["a"] or 0.0) + 0.5) / ((clean["b"] or 0.0) + 1) * float(np.exp(3 * model.rate))
    got = measured(True).toPandas().sort_values(["label", "a", "b"])
    if got.label.nunique() == 2:
        model.curve = _logistic(got[["a", "b"]].to_numpy(), got.label.to_numpy())
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = THRESHOLD, **params) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = fitted(docs, labels, id_col, text_col, label_col, **params)
    folds, held = params.get("folds", FOLDS), params.get("held_out", HELD_OUT)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [model.document_scores(chunk) for _, chunk in text_chunks([batch], 0)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t")).withColumn("score", score("t"))
    return rows.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "score",
                       F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def toxic_passages(docs: DataFrame, model: PassageModel, id_col: str = "doc_id", text_col: str = "text", max_e: float = MAX_E) -> DataFrame:
    """Every significant passage: doc_id, first_byte, end_byte, score, e_value, passage."""
    executors_ready(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b, texts in text_chunks(batches, 1):
            out = [(i, a, z, s, model.e_value(n, s), texts[i][a:z].decode("utf-8", "replace"))
                   for i, (n, found) in enumerate(model.segments(texts)) for a, z, s in found if model.e_value(n, s) <= max_e]
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), *map(pa.array, cols[1:], kinds)],
                                             names=["doc_id", "first_byte", "end_byte", "score", "e_value", "passage"])

    return rows.mapInArrow(run, f"doc_id {kind}, first_byte long, end_byte long, score double, e_value double, passage string")
