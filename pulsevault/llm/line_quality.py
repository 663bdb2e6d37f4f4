"""Document quality from a linear-chain conditional random field over lines.

Every line is good (0) or bad (1). A line's features describe its own bytes and words and those of the
lines before and after it; the chain adds a weight for each pair of neighbouring labels. The field is
fitted by maximum likelihood to a bounded sample of labelled documents (``FIT_DOCS``, chosen by a hash of
the id), first with each line carrying its document's label, then again with the lines of bad documents
relabelled by the fitted marginals (at least one stays bad). A document's badness is the mean of its
lines' forward-backward marginals, weighted by line length; a logistic curve fitted to the same sample
maps it to the probability of label 1.

Scoring is one narrow pass over all whole texts; only the fitted weights (a few hundred numbers) and the
sample's ids are broadcast.

Defined results: a null text equals the empty text, which is one empty line; a null or missing label is
no label; an id labelled several times counts as bad if its mean label is below 0.5; without labels of
both kinds every score is 0.5; repeated rows are scored each; an empty table gives an empty table; only
the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import crc_mod, executors_ready, text_chunks, text_of, unused
from pulsevault.llm.words import joined, mixed, word_hashes

FIT_DOCS = 4_000
#: Longer documents take no part in the fit (they are scored like all others).
FIT_BYTES = 256 << 10
FIT_STEPS = 150
#: Long documents are fitted in stretches of so many lines (scoring uses whole documents).
FIT_LINES = 64
FOLDS, HELD_OUT = 3, 1

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 11, 12, 13, 32]], _CLASS[128:] = 4, 5
for _k, _chars in ((6, b"!?"), (7, b"|"), (8, b".,;:'\"()-"), (9, b"#$%&*@^~<>=+_\\/[]{}`")):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _k
_SHARES = (1, 2, 3, 4, 5, 6, 7, 8, 9)
N_OWN = len(_SHARES) + 6
N_FEATURES = 3 * N_OWN + 1


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, lines per text, bytes per line) of all texts."""
    data, bounds = joined(texts)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    size = (ends - starts).astype(np.float64)
    per_text = np.diff(np.searchsorted(ends, bounds))
    text_of_line = np.repeat(np.arange(len(texts)), per_text)
    kinds = _CLASS[data]
    own = np.zeros((len(ends), N_OWN), np.float64)
    wide = np.maximum(size, 1)
    for i, k in enumerate(_SHARES):
        upto = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int64)))
        own[:, i] = (upto[ends] - upto[starts]) / wide
    hashes, at = word_hashes(data)
    line = np.searchsorted(ends, at)
    words = np.bincount(line, minlength=len(ends)).astype(np.float64)
    many = np.maximum(words, 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    _, first = np.unique(hashes ^ mixed(line.astype(np.uint64)), return_index=True)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)))
    edges = np.concatenate(([0], np.cumsum(words))).astype(np.int64)
    whole = mixed(sums[edges[1:]] - sums[edges[:-1]]) ^ mixed(text_of_line.astype(np.uint64) + np.uint64(7))
    _, back, times = np.unique(whole, return_inverse=True, return_counts=True)
    j = len(_SHARES)
    own[:, j] = np.log1p(size) / 8
    own[:, j + 1] = np.log1p(words) / 6
    own[:, j + 2] = np.minimum(size / many, 40) / 20
    own[:, j + 3] = np.bincount(line, again, minlength=len(ends)) / many
    own[:, j + 4] = np.bincount(line[first], minlength=len(ends)) / many
    own[:, j + 5] = times[back] > 1
    same = np.zeros(len(ends), bool)
    same[1:] = text_of_line[1:] == text_of_line[:-1]
    out = np.zeros((len(ends), N_FEATURES), np.float64)
    out[:, :N_OWN] = own
    out[1:, N_OWN:2 * N_OWN] = own[:-1] * same[1:, None]
    out[:-1, 2 * N_OWN:3 * N_OWN] = own[1:] * same[1:, None]
    out[:, -1] = 1
    return out, per_text, size + 1


def _messages(s: np.ndarray, lengths: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds of bad against good for every line. ``s``: the lines' own log-odds,
    chain after chain. Runs over positions, all chains at once."""
    ahead, behind = np.zeros(len(s)), np.zeros(len(s))
    by_length = np.argsort(-lengths, kind="stable")
    n, first = lengths[by_length], (np.cumsum(lengths) - lengths)[by_length]
    last = first + n - 1
    live = np.searchsorted(-n, -np.arange(1, int(n[0]) + 1 if len(n) else 1), side="right")
    for t, k in enumerate(live):
        at = first[:k] + t
        if t == 0:
            ahead[at] = s[at]
            continue
        r = ahead[at - 1]
        ahead[at] = s[at] + np.logaddexp(pair[0, 1], r + pair[1, 1]) - np.logaddexp(pair[0, 0], r + pair[1, 0])
        at = last[:k] - t
        r = behind[at + 1] + s[at + 1]
        behind[at] = np.logaddexp(pair[1, 0], r + pair[1, 1]) - np.logaddexp(pair[0, 0], r + pair[0, 1])
    return ahead, behind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class LineField:
    """Fitted field: weights of the features for 'bad', weights of label pairs, curve of the documents."""

    weights: np.ndarray
    pair: np.ndarray
    curve: tuple[float, float]

    def marginals(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability that each line is bad."""
        ahead, behind = _messages(x @ self.weights, lengths, self.pair)
        return _sigmoid(ahead + behind)

    def badness(self, x: np.ndarray, lengths: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each text."""
        if not len(lengths):
            return np.zeros(0)
        at = np.cumsum(lengths) - lengths
        return np.add.reduceat(self.marginals(x, lengths) * size, at) / np.add.reduceat(size, at)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of each text."""
        if self.curve is None:
            return np.full(len(texts), 0.5)
        return _sigmoid(self.curve[0] - self.curve[1] * _stretched(self.badness(*line_features(texts))))


def _stretched(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _fit_field(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, steps: int) -> LineField:
    """Maximum likelihood with a small ridge, by Adam."""
    theta, m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    ends = np.cumsum(lengths)
    inner = np.ones(len(y), bool)
    inner[ends[lengths > 0] - 1] = False
    here = np.flatnonzero(inner)
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[here], y[here + 1]), 1)
    for step in range(1, steps + 1):
        w, pair = theta[:-4], theta[-4:].reshape(2, 2)
        s = x @ w
        ahead, behind = _messages(s, lengths, pair)
        p = _sigmoid(ahead + behind)
        logs = np.stack([np.full(len(here), pair[0, 0]), pair[0, 1] + s[here + 1] + behind[here + 1],
                         ahead[here] + pair[1, 0], ahead[here] + pair[1, 1] + s[here + 1] + behind[here + 1]])
        joint = np.exp(logs - np.logaddexp.reduce(logs, axis=0)).sum(axis=1).reshape(2, 2) if len(here) else np.zeros((2, 2))
        grad = np.concatenate([x.T @ (y - p), (observed - joint).ravel()]) / len(y) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return LineField(theta[:-4], theta[-4:].reshape(2, 2), (0.0, 1.0))


def fit(features: list[tuple[np.ndarray, np.ndarray, int]], steps: int = FIT_STEPS) -> LineField:
    """Fit to (line features, bytes per line, label 0/1) of each document; label 1 is good."""
    labels = np.array([lab for _, _, lab in features])
    if not len(labels) or labels.min() == labels.max():
        return LineField(np.zeros(N_FEATURES), np.zeros((2, 2)), None)
    x = np.concatenate([f for f, _, _ in features])
    size = np.concatenate([n for _, n, _ in features])
    lengths = np.array([len(n) for _, n, _ in features])
    stretch = np.concatenate([np.full(-(-n // FIT_LINES), FIT_LINES) for n in lengths])
    stretch[np.cumsum(-(-lengths // FIT_LINES)) - 1] = (lengths - 1) % FIT_LINES + 1
    bad_text = np.repeat(labels == 0, lengths)
    field = _fit_field(x, bad_text.astype(np.int64), stretch, steps)
    p = field.marginals(x, lengths)
    first = np.cumsum(lengths) - lengths
    y = bad_text & ((p >= 0.5) | (p >= np.repeat(np.maximum.reduceat(p, first), lengths)))
    field = _fit_field(x, y.astype(np.int64), stretch, steps)
    z = _stretched(field.badness(x, lengths, size))
    a = b = 0.0
    for _ in range(50):  # Newton steps of the logistic curve
        q = _sigmoid(a - b * z)
        g, h = labels - q, q * (1 - q) + 1e-9
        hessian = np.array([[h.sum(), -(h * z).sum()], [-(h * z).sum(), (h * z * z).sum()]]) + np.eye(2) * 1e-2
        da, db = np.linalg.solve(hessian, [g.sum() - 1e-2 * a, -(g * z).sum() - 1e-2 * b])
        a, b = a + da, b + db
    field.curve = (float(a), float(b))
    return field


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, limit: int, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of at most ``limit`` labelled ids outside the held-out fold, by a hash of the id."""
    known = labels.filter(labels[id_col].isNotNull() & labels[label_col].isNotNull())
    known = known.groupBy(known[id_col].alias("__id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("__label"))
    known = known.filter(crc_mod(F.col("__id"), folds) != held_out)
    return known.orderBy(F.xxhash64(F.col("__id").cast("string"), F.lit(17)), "__id").limit(limit)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
           fit_docs: int = FIT_DOCS, folds: int = FOLDS, held_out: int = HELD_OUT) -> LineField:
    """The field fitted to labelled documents outside the held-out fold. The features of the sample come to the
    driver: at most ``fit_docs`` documents of at most ``FIT_BYTES`` bytes each; an id that several rows carry
    counts once, with the text of the smallest hash."""
    executors_ready(docs.sparkSession)
    ids = labelled_sample(labels, id_col, label_col, fit_docs, folds, held_out)
    rows = docs.select(docs[id_col].alias("__id"), text_of(docs, text_col).alias("__text"))
    rows = rows.filter(F.octet_length("__text") <= FIT_BYTES).join(F.broadcast(ids), "__id")
    one = F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text")
    rows = rows.groupBy("__id", "__label").agg(one).select("__label", "__text")

    def run(batches):
        for b, texts in text_chunks(batches, 1):
            x, per_text, size = line_features(texts)
            cut = np.cumsum(per_text)[:-1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int32()), pa.array([p.astype(np.float32).tobytes() for p in np.split(x, cut)], pa.binary()),
                 pa.array([p.astype(np.float32).tobytes() for p in np.split(size, cut)], pa.binary())],
                names=["label", "x", "size"])

    got = rows.mapInArrow(run, "label int, x binary, size binary").toPandas().sort_values(["label", "x"])
    return fit([(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(np.float64), np.frombuffer(s, np.float32).astype(np.float64), int(lab))
                for lab, x, s in got.itertuples(index=False)])


def with_score(docs: DataFrame, field: LineField, text_col: str = "text", name: str = "__score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``name``."""
    executors_ready(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        parts = [field.scores(chunk) for _, chunk in text_chunks([batch], 0)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.withColumn(name, score(text_of(docs, text_col)))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", **params) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    field = fitted(docs, labels, id_col, text_col, label_col, **params)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    folds, held = params.get("folds", FOLDS), params.get("held_out", HELD_OUT)
    scored = with_score(rows, field, "text", "score")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = 0.5, **params) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns."""
    field = fitted(docs, labels, id_col, text_col, label_col, **params)
    name = unused(docs, "__score")
    return with_score(docs, field, text_col, name).filter(F.col(name) >= threshold).drop(name)
