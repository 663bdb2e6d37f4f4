"""Embedding whitening by a bidiagonal qd solver.

Entries become integers, ``floor(1024 c) + 100000``, so that the sums of a fit list are exact. Every task reduces
its centred rows block by block to one triangle R (QR), and the tasks' triangles are reduced the same way in
rounds of ``FAN``. The last triangle has the singular values and right singular vectors of all centred rows:
Householder reflections make it bidiagonal, dqds (zero-shift sweeps, whose diagonal bounds the smallest value
from below, in turn with sweeps shifted by that bound) finds its singular values, and twisted factorisations
of the shifted tridiagonal give the vectors, made orthogonal within clusters of close values and carried
back through the reflections. The rows are read four times (sums, triangles, check, result) and never shuffled.

A triangle holds d x d doubles; a task keeps two, the driver solves one (d steps of d x d each).

Defined results: null vectors and vectors that hold nulls, NaN or infinities are left out; an empty vector has
no components; vectors of different lengths are fit lists of their own; entries beyond 2**30 count as 2**30;
components whose singular value is rounding noise (at most 8 d eps of the largest: fewer rows than dimensions,
equal rows) do not exist, so a fit list of one vector has no rows; a deviation beyond 2**63 - 1 is null;
repeated rows count and are returned each; of equal eigenvalues any orthonormal basis serves; an empty table
gives an empty table; only the id and the vector are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import executors_ready, stored

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Triangles that meet in one task of a round, and that the driver takes at last.
FAN = 16
_LARGEST = float(1 << 40)
_EPS = np.finfo(float).eps
_TINY = 1e-290


# -- the solver: numpy on one triangle ------------------------------------------------------------------------------


def triangle(rows: np.ndarray) -> np.ndarray:
    """The d x d triangle R of rows (k x d), filled up with zeros."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack((r, np.zeros((rows.shape[1] - len(r), rows.shape[1])))) if len(r) < rows.shape[1] else r


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta of the reflection 1 - beta v v' that leaves only the first entry of ``x``."""
    norm = np.sqrt(np.dot(x, x))
    v = x.copy()
    if norm == 0 or len(x) == 1:
        return v, 0.0
    v[0] += norm if x[0] >= 0 else -norm
    return v, 2 / np.dot(v, v)


def bidiagonal(r: np.ndarray):
    """(diagonal, superdiagonal, right reflections) of U' R W."""
    a, right = r.copy(), []
    for k in range(len(a)):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < len(a) - 2:
            v, beta = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
            right.append((v, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float):
    """One dqds transform: (q, e, d) of the matrix less ``shift``, or None if a value fell below zero."""
    n, d = len(q), q[0] - shift
    out_q, out_e, all_d = [0.0] * n, [0.0] * (n - 1), [d]
    if d < 0:
        return None
    for i in range(n - 1):
        out_q[i] = d + e[i]
        ratio = q[i + 1] / out_q[i] if out_q[i] > 0 else 0.0
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
        if d < 0:
            return None
        all_d.append(d)
    out_q[-1] = d
    return out_q, out_e, all_d


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Falling squares of the singular values of an upper bidiagonal matrix, by dqds."""
    top = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if top == 0:
        return np.zeros(len(diagonal))
    found, small = [], (10 * _EPS) ** 2
    blocks = [(((diagonal / top) ** 2).tolist(), ((above / top) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(100 * len(q) + 100):
            while len(q) > 1 and e[-1] <= small * (moved + q[-1]) + 1e-300:
                found.append(moved + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(moved + q[0])
                q = []
            if not q:
                break
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= small * (moved + min(q[i], q[i + 1])) + 1e-300), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
            if 1.5 * q[0] < q[-1]:  # the same values from the other end: small ones leave at the bottom
                q, e = _turned(q, e)
            q, e, d = _sweep(q, e, 0.0)
            if min(d) > 0:
                shift = (1 - 8 * len(q) * _EPS) / sum(1 / x for x in d)  # at most the smallest value
                shifted = _sweep(q, e, shift)
                if shifted:
                    q, e, _ = shifted
                    moved += shift
        else:
            raise RuntimeError("dqds did not converge")
    return np.sort(np.array(found))[::-1] * top ** 2


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The transposed bidiagonal with its rows and columns in reverse order: the same singular values."""
    return q[::-1], e[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for ``value``: the twisted factorisation of B'B - value with the least pivot."""
    q, e, g, n = (diagonal ** 2).tolist(), (above ** 2).tolist(), (diagonal[:-1] * above).tolist(), len(diagonal)
    down, up, s, p = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    safe = lambda x: x if abs(x) > _TINY else (-_TINY if x < 0 else _TINY)
    s[0], p[-1] = -value, q[-1] - value
    for i in range(n - 1):
        pivot = safe(s[i] + q[i])
        down[i] = g[i] / pivot
        s[i + 1] = e[i] / pivot * s[i] - value
    for i in range(n - 2, -1, -1):
        pivot = safe(e[i] + p[i + 1])
        up[i] = g[i] / pivot
        p[i] = q[i] / pivot * p[i + 1] - value
    at = int(np.argmin(np.abs(np.array(s) + np.array(p) + value)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
    z /= np.abs(z).max()
    return z / np.sqrt(np.dot(z, z))


def _away_from(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            z = z - np.dot(o, z) * o
    return z


def vectors_of(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Orthonormal eigenvectors of B'B for its largest values (falling), also where values are close or equal."""
    out: list[np.ndarray] = []
    top = np.sqrt(values[0])
    diagonal, above, values = diagonal / top, above / top, values / values[0]
    for j, value in enumerate(values):
        near = [out[i] for i in range(j) if values[i] - value <= 1e-3 * value]
        z = _away_from(twisted_vector(diagonal, above, value), near)
        if np.sqrt(np.dot(z, z)) < 0.5:  # values equal to rounding: inverse iteration beside the vectors found
            square = np.diag(diagonal ** 2) + np.diag(np.append(0.0, above ** 2)) - value * (1 + 4 * _EPS) * np.eye(len(diagonal))
            square += np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
            square[np.diag_indices(len(square))] += _EPS * 1e-3
            z = np.cos(np.arange(1.0, len(diagonal) + 1) * (j + 1))
            for _ in range(4):
                z = _away_from(np.linalg.solve(square, _away_from(z, near)), near)
                z /= np.sqrt(np.dot(z, z))
        out.append(z / np.sqrt(np.dot(z, z)))
    return out


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, unit right singular vectors as columns, their sum over all) of the ``k``
    largest that are more than rounding noise; each vector's entry of largest size is positive."""
    size = np.abs(r).max(initial=0)
    if size == 0:
        return np.zeros(0), np.zeros((r.shape[1], 0)), 0.0
    diagonal, above, right = bidiagonal(r / size)
    values = squared_singular_values(diagonal, above)
    real = values > (8 * len(r) * _EPS) ** 2 * values[0]
    some = values[:k][real[:k]]
    columns = []
    for z in vectors_of(diagonal, above, some):
        for i in range(len(right) - 1, -1, -1):
            v, beta = right[i]
            z[i + 1:] -= beta * np.dot(v, z[i + 1:]) * v
        z /= np.sqrt(np.dot(z, z))
        columns.append(z if z[np.argmax(np.abs(z))] > 0 else -z)
    return some * size ** 2, np.stack(columns, 1), float((r * r).sum())


# -- Spark ----------------------------------------------------------------------------------------------------------


@dataclass
class Fit:
    """A fit list: its size and sums, and what the solver found."""

    n: int
    sums: np.ndarray
    values: np.ndarray | None = None
    directions: np.ndarray | None = None
    trace: float = 0.0
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(float) / self.n

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in 64 bits where they suffice, else in Python's integers."""
        if self.sums.dtype == object or float(self.n) * max(float(np.abs(x).max(initial=0)), 1.0) > 2.0 ** 61:
            return x.astype(object) * self.n - self.sums.astype(object)
        return x * self.n - self.sums

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y = self.spread(x)
        if y.dtype != object and (y.astype(float) ** 2).sum(1).max(initial=0) < 9e18:
            return (y * y).sum(1).tolist()
        whole = [sum(int(v) * int(v) for v in row) for row in y.tolist()]
        return [w if w < 1 << 63 else None for w in whole]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.values / self.n)


def _integers(vectors: pa.Array):
    """(rows, integer matrix) for each length of vector in a batch."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    x = (np.clip(np.floor(flat * SCALE), -_LARGEST, _LARGEST) + OFFSET).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        yield rows, x[starts[rows][:, None] + np.arange(d)]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): rows whose vector has only finite entries."""
    v = vectors[vec_col].cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(vectors[id_col].alias("vec_id"), v.alias("v")).filter(vectors[vec_col].isNotNull() & finite)


def _sums(rows: DataFrame) -> dict[int, Fit]:
    def run(batches):
        held: dict = {}
        for b in batches:
            for some, x in _integers(b.column(0)):
                d = x.shape[1]
                n, sums = held.get(d, (0, np.zeros(d, np.int64)))
                held[d] = (n + len(some), sums + x.sum(0))
                if abs(int(held[d][1].max())) > 1 << 61 or abs(int(held[d][1].min())) > 1 << 61:
                    yield _sum_row(d, *held.pop(d))
        for d, (n, sums) in held.items():
            yield _sum_row(d, n, sums)

    parts = rows.select("v").mapInArrow(run, "d int, n long, sums array<long>")
    each = parts.select("d", "n", F.posexplode("sums").alias("at", "s"))
    got = each.groupBy("d", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    fits: dict[int, Fit] = {}
    for r in sorted(got, key=lambda r: (r["d"], r["at"])):
        fits.setdefault(r["d"], Fit(r["n"], [])).sums.append(int(r["s"]))
    for fit in fits.values():
        fit.sums = np.array(fit.sums, np.int64 if max(map(abs, fit.sums)) < 1 << 62 else object)
    return fits


def _sum_row(d, n, sums):
    return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.int64()))],
                                      names=["d", "n", "sums"])


def _triangle_row(d, part, r):
    return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))],
                                      names=["d", "part", "r"])


def _triangles(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, np.ndarray]:
    """The triangle of each fit list's centred rows."""
    schema = "d int, part long, r array<double>"

    def reduced(batches):
        held: dict = {}
        part = 0
        for b in batches:
            part = b.column(0)[0].as_py()
            for _, x in _integers(b.column(1)):
                d = x.shape[1]
                r, waiting, n = held.get(d, (None, [], 0))
                waiting.append(fits[d].centred(x))
                n += len(x)
                if n >= max(1024, 4 * d):
                    r, waiting, n = triangle(np.vstack([*([] if r is None else [r]), *waiting])), [], 0
                held[d] = (r, waiting, n)
        for d, (r, waiting, _) in held.items():
            yield _triangle_row(d, part, triangle(np.vstack([*([] if r is None else [r]), *waiting])) if waiting else r)

    def merged(batches):
        now, r = None, None
        for b in batches:
            for d, part, flat in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                mine = flat.values.to_numpy().reshape(d, d)
                if now != (d, part):
                    if now:
                        yield _triangle_row(*now, r)
                    now, r = (d, part), mine
                else:
                    r = triangle(np.vstack((r, mine)))
        if now:
            yield _triangle_row(*now, r)

    found = stored(rows.select(F.spark_partition_id().cast("long").alias("part"), "v").mapInArrow(reduced, schema), "whitening-triangles")
    while (last := found.agg(F.max("part")).first()[0] or 0) >= FAN:
        joined = found.select("d", F.floor(F.col("part") / FAN).alias("part"), "r")
        joined = joined.repartition(last // FAN + 1, "d", "part").sortWithinPartitions("d", "part")
        found = stored(joined.mapInArrow(merged, schema), "whitening-triangles")
    out: dict[int, np.ndarray] = {}
    for row in found.orderBy("d", "part").toLocalIterator():  # FAN triangles of each fit list at most
        mine = np.array(row["r"]).reshape(row["d"], row["d"])
        out[row["d"]] = triangle(np.vstack((out[row["d"]], mine))) if row["d"] in out else mine
    return out


def _check(rows: DataFrame, fits: dict[int, Fit]) -> None:
    """Sets every fit's ``error``: the largest entry of its whitened rows' covariance minus the identity."""
    def run(batches):
        held: dict = {}
        for b in batches:
            for _, x in _integers(b.column(0)):
                d = x.shape[1]
                if fits[d].values is not None and len(fits[d].values):
                    w = fits[d].whitened(x)
                    held[d] = held.get(d, 0) + w.T @ w
        for d, g in held.items():
            yield _triangle_row(d, 0, g)

    parts = rows.select("v").mapInArrow(run, "d int, part long, r array<double>")
    got = parts.select("d", F.posexplode("r").alias("at", "g")).groupBy("d", "at").agg(F.sum("g").alias("g")).collect()
    for r in got:
        fit = fits[r["d"]]
        k = len(fit.values)
        fit.error = max(fit.error, abs(r["g"] / fit.n - (r["at"] // k == r["at"] % k)))


def fitted(rows: DataFrame, k: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length of vector in ``rows`` (column v of usable vectors)."""
    fits = _sums(rows)
    for d, r in _triangles(rows, fits).items():
        fits[d].values, fits[d].directions, fits[d].trace = principal(r, k)
    _check(rows, fits)
    return fits


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component up to ``k``: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    executors_ready(vectors.sparkSession)
    rows = usable(vectors, id_col, vec_col)
    fits = fitted(rows, k)
    id_kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for some, x in _integers(b.column(1)):
                fit = fits[x.shape[1]]
                m = len(fit.values)
                if not m:
                    continue
                w = fit.whitened(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(some, m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(some))),
                     pa.array(np.full(len(some) * m, fit.n, np.int64)),
                     pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), m))),
                     pa.array(w.ravel()), pa.array(np.tile(fit.values / fit.trace, len(some))),
                     pa.array(np.full(len(some) * m, fit.error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {id_kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
