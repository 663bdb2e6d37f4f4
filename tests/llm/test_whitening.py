import math
import random

import numpy as np
import pytest

from pulsevault.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def matrices():
    rng = np.random.default_rng(7)
    for d in (1, 2, 3, 5, 16, 64):
        yield f"plain {d}", rng.normal(size=(200, d))
        yield f"graded {d}", rng.normal(size=(200, d)) * 10.0 ** -np.linspace(0, 12, d)
        yield f"low rank {d}", rng.normal(size=(100, max(d // 3, 1))) @ rng.normal(size=(max(d // 3, 1), d))
        yield f"few rows {d}", rng.normal(size=(max(d // 2, 1), d))
        yield f"equal values {d}", np.linalg.qr(rng.normal(size=(100, d)))[0] * 3
        yield f"two clusters {d}", np.linalg.qr(rng.normal(size=(100, d)))[0] * np.where(np.arange(d) < d // 2, 5.0, 1.0)
        yield f"close values {d}", np.linalg.qr(rng.normal(size=(100, d)))[0] * (1 + 1e-9 * np.arange(d))
        yield f"diagonal {d}", np.diag(np.arange(d, 0, -1.0))
        yield f"zero columns {d}", rng.normal(size=(50, d)) * (np.arange(d) % 2)
        yield f"huge {d}", rng.normal(size=(50, d)) * 1e150
    yield "wilkinson", np.linalg.cholesky(np.diag(np.abs(np.arange(-10.0, 11)) + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T


@pytest.mark.parametrize("name,a", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_solver_against_the_library(name, a):
    values, vectors, total = W.principal(W.triangle(a), 8)
    scale = np.abs(a).max()
    true = np.linalg.svd(a / scale if scale else a, compute_uv=False) ** 2
    rank = int((true > (1e-13 * len(true)) ** 2 * true[0]).sum()) if true[0] > 0 else 0
    assert len(values) == min(8, rank)
    if rank:
        np.testing.assert_allclose(np.sqrt(values) / scale, np.sqrt(true[:len(values)]), rtol=1e-9, atol=1e-14 * np.sqrt(true[0]))
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-11)
        b = a / scale
        wrong = np.abs(b.T @ (b @ vectors) - vectors * (values / scale ** 2)).max(initial=0)
        assert wrong <= 1e-11 * true[0]
        assert math.isclose(total / scale ** 2, true.sum(), rel_tol=1e-10)


def test_small_values_keep_their_digits():
    diagonal = 10.0 ** -np.arange(0.0, 24, 2)
    above = diagonal[:-1] * 0.5
    values = W.squared_singular_values(diagonal, above)
    from fractions import Fraction
    assert math.isclose(math.prod(values), float(math.prod(Fraction(x) ** 2 for x in diagonal)), rel_tol=1e-12)


def plain(table, k=8):
    groups = {}
    for i, v in table:
        if v and all(c is not None and math.isfinite(c) for c in v):
            groups.setdefault(len(v), []).append((i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]))
    out = {}
    for rows in groups.values():
        n, sums = len(rows), [sum(c) for c in zip(*(x for _, x in rows))]
        y = np.array([[n * a - s for a, s in zip(x, sums)] for _, x in rows], float) / n
        e, v = np.linalg.eigh(y.T @ y / n)
        e, v = e[::-1], v[:, ::-1]
        for m in range(min(k, int((e > 1e-9 * e[0]).sum()) if e[0] > 0 else 0)):
            for (i, x), w in zip(rows, y @ v[:, m] / np.sqrt(e[m])):
                out.setdefault((i, m + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), w, e[m] / np.trace(y.T @ y / n)))
    return out


def same(got, want):
    assert len(got) == sum(map(len, want.values()))
    signs = {}
    for r in sorted(got, key=lambda r: (r.vec_id or 0, r.component)):
        options = [o for o in want[(r.vec_id, r.component)] if o[:2] == (r.n, r.deviation)]
        assert any(abs(abs(o[2]) - abs(r.whitened)) < 1e-6 and math.isclose(o[3], r.explained, rel_tol=1e-7) for o in options), r
        assert r.identity_error < 1e-9
        if len(options) == 1 and abs(r.whitened) > 1e-3:
            signs.setdefault((r.n, r.component), set()).add(np.sign(options[0][2] * r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_query_over_odd_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, j + 1) for j in range(12)]) for i in range(300)]
    rows += [(300 + i, [rng.gauss(0, j + 1) for j in range(3)]) for i in range(40)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (400, None), (401, []), (402, [1.0, None, 2.0]), (403, [float("nan")] * 12),
             (404, [float("inf")] + [0.0] * 11), (405, [1.0] * 7), (406, [2.0] * 9), (407, [2.0] * 9)]
    want = plain(rows)
    table = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", v string").repartition(40)
    monkeypatch.setattr(W, "FAN", 3)
    same(W.whitened(table).collect(), want)


def test_empty_and_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert W.whitened(table.limit(0)).count() == 0
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    same(W.whitened(table).collect(), plain(rows))


def test_deviations_beyond_64_bits_are_exact_or_null():
    x = np.array([[1 << 40, 3], [5, 7]])
    fit = W.Fit(4, np.array([10, 20]))
    assert fit.deviations(x) == [None, (4 * 5 - 10) ** 2 + (4 * 7 - 20) ** 2]
    fit = W.Fit(1 << 30, np.array([0, 0]))
    assert fit.deviations(np.array([[1, 0], [2, 0]])) == [1 << 60, 1 << 62]
    assert fit.deviations(np.array([[3, 0]])) == [None]
