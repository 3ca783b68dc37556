"""Whitening of embeddings on leading principal components found by Jacobi-Davidson.

The covariance matrix is never formed. Spark gives its products with a few vectors: every
task sums ``d (d . v)`` over its own rows, where ``d = x - S/n`` is taken from whole numbers
(``x - floor(S/n)``, less a fraction below one), so a large common offset costs no digit.
Only blocks of ``dimensions x vectors`` numbers travel.

The driver keeps a small search space. Each round

* solves the eigenproblem inside the space (Rayleigh-Ritz);
* locks the leading pairs whose residual has reached double precision; the space stays
  orthogonal to them;
* solves the projected correction equation ``(I-PP')(V - theta)(I-PP') t = -r`` of every open
  pair by a few steps of MINRES, all pairs in step, one product a step, and adds the
  corrections to the space.

Rounds go on until all residuals are down; a last Rayleigh-Ritz over the locked vectors takes
out what locking one after the other has left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import partition_id, prepare, written

EPS = float(np.finfo(np.float64).eps)
#: Entries beyond this size have no exact whole number below 2**62 after scaling.
LARGEST = 2.0 ** 51


@dataclass(frozen=True)
class WhiteningParams:
    """``guard``: vectors beside the wanted ones; ``basis``: columns of the search space;
    ``digits``: residuals below ``digits * EPS * sqrt(dimensions) * largest eigenvalue`` are
    at double precision; ``floor``: variances below this share of the largest count as none."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    guard: int = 4
    basis: int = 64
    inner: int = 8
    rounds: int = 200
    digits: float = 8.0
    floor: float = 1e-12
    fan_in: int = 256
    seed: int = 7


@dataclass
class Fit:
    """Whole-number statistics of the ``n`` vectors and the wanted eigenpairs."""

    n: int
    low: np.ndarray        # floor(S / n)
    rest: np.ndarray       # S - n * low
    values: np.ndarray
    vectors: np.ndarray    # a column each
    trace: float
    residuals: np.ndarray
    products: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.low).astype(np.float64) - self.rest / max(1, self.n)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


@dataclass(frozen=True)
class WholeVectors:
    """A written table ``(vec_id, x)``, ``x`` the entries ``floor(scale * c) + shift`` as packed
    64-bit numbers; the number of dimensions, and of tasks that read the table."""

    rows: DataFrame
    dim: int
    tasks: int


def whole_vectors(vectors: DataFrame, p: WhiteningParams, id_col: str, vec_col: str) -> WholeVectors:
    """The vectors that take part (see ``whitened``)."""
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fit = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    v = v.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fit))
    common = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dim = int(common["d"]) if common else 0

    def pack(batches):
        for b in batches:
            c = b.column(1).flatten().to_numpy(zero_copy_only=False)
            x = np.floor(p.scale * c).astype(np.int64) + p.shift
            offs = np.arange(b.num_rows + 1, dtype=np.int32) * (8 * dim)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.Array.from_buffers(pa.binary(), b.num_rows, [
                None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(x))])], ["vec_id", "x"])

    rows = written(v.filter(F.size("v") == dim).mapInArrow(pack, "vec_id long, x binary"), "whole-vectors")
    return WholeVectors(rows, dim, rows.select(F.spark_partition_id()).distinct().count())


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    at = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)
    return np.frombuffer(col.buffers()[2], np.int64, (at[-1] - at[0]) // 8, int(at[0])).reshape(len(col), dim)


def _total(data: WholeVectors, shape: tuple[int, ...], of, fan_in: int) -> np.ndarray:
    """Sum of ``of(matrix of a batch)`` over all rows: a sum a task, added in the tasks' order;
    of many tasks, first in groups on the executors."""
    dim = data.dim
    kind = of(np.zeros((0, dim), np.int64)).dtype

    def add(batches):
        acc = None
        for b in batches:
            if b.num_rows:
                got = of(_matrix(b.column(0), dim))
                acc = got if acc is None else acc + got
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([partition_id()], pa.int32()), pa.array([acc.tobytes()], pa.binary())], ["k", "v"])

    def join(batches):
        got = sorted((k, v) for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if got:
            total = sum(np.frombuffer(v, kind) for _, v in got)
            yield pa.RecordBatch.from_arrays([pa.array([got[0][0]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["k", "v"])

    parts = data.rows.select("x").mapInArrow(add, "k int, v binary")
    if data.tasks > fan_in:
        g = int(data.tasks ** 0.5) + 1
        parts = parts.repartition(g, F.col("k") % g).mapInArrow(join, "k int, v binary")
    got = sorted((r["k"], bytes(r["v"])) for r in parts.collect())  # at most ``fan_in`` or about sqrt(tasks) sums
    return sum((np.frombuffer(v, kind) for _, v in got), np.zeros(int(np.prod(shape)), kind)).reshape(shape)


def minres(op, b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of ``op(x) = b`` for a symmetric ``op``, a column each, all columns
    in step: at most ``steps`` products, fewer once every residual is ``enough`` times smaller."""
    x, v_old, w_old, w = (np.zeros_like(b) for _ in range(4))
    beta = np.linalg.norm(b, axis=0)
    live = beta > 0
    v = b / np.where(live, beta, 1)
    eta, start, beta = beta.copy(), beta.copy(), np.zeros_like(beta)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    for _ in range(steps):
        u = op(v)
        alpha = (v * u).sum(0)
        u = u - alpha * v - beta * v_old
        beta_new = np.linalg.norm(u, axis=0)
        r1 = c * alpha - c_old * s * beta
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        rho = np.hypot(r1, beta_new)
        live &= rho > 0
        rho = np.where(live, rho, 1)
        c_old, s_old, c, s = c, s, r1 / rho, beta_new / rho
        w_old, w = w, (v - r3 * w_old - r2 * w) / rho
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        v_old, v, beta = v, u / np.where(beta_new > 0, beta_new, 1), beta_new
        live &= beta_new > 0
        if not live.any() or np.all(np.abs(eta) <= enough * start):
            break
    return x


def _orthonormal(t: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """An orthonormal base of what the columns of ``t`` add to the given columns."""
    size = np.linalg.norm(t, axis=0)
    t = t[:, size > 0] / size[size > 0]
    out = np.zeros((len(t), 0))
    for j in range(t.shape[1]):
        v = t[:, j]
        for _ in range(3):
            for q in (*against, out):
                v = v - q @ (q.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        else:
            out = np.column_stack((out, v))
    return out


def jacobi_davidson(product, dim: int, p: WhiteningParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(values, vectors, residual norms, products)`` of the leading eigenpairs of a symmetric
    matrix given by its ``product`` with a block of vectors."""
    want = min(p.components, dim)
    calls = 0

    def times(m: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return product(m)

    rng = np.random.default_rng(p.seed)
    width = min(dim, want + p.guard)
    space = _orthonormal(rng.standard_normal((dim, width)), [])
    image = times(space)
    locked = np.zeros((dim, 0))
    largest, best, stale = 0.0, np.inf, 0
    for _ in range(p.rounds):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        u, vu = space @ y, image @ y
        largest = max(largest, float(theta[0]))
        res = vu - u * theta
        res = res - locked @ (locked.T @ res)
        size = np.linalg.norm(res, axis=0)
        done = size <= p.digits * EPS * np.sqrt(dim) * largest
        open_ = want - locked.shape[1]
        # no further direction, or rounding keeps the residuals where they are: as good as they get
        worst = float(size[:open_].max())
        stale = stale + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if locked.shape[1] + space.shape[1] >= dim and stale > 1 or stale > 4 and worst <= 1e-12 * largest:
            done[:] = True
        lead = int(np.argmin(done)) if not done.all() else len(done)
        lead = min(lead, open_)
        if lead:
            locked = np.column_stack((locked, u[:, :lead]))
            u, vu, theta, res = u[:, lead:], vu[:, lead:], theta[lead:], res[:, lead:]
            best, stale = np.inf, 0
        if locked.shape[1] == want:
            break
        space, image = u, vu
        open_ = want - locked.shape[1]
        if space.shape[1] + open_ > max(p.basis, 2 * width):
            space, image = space[:, :width], image[:, :width]
        if locked.shape[1] + space.shape[1] >= dim:  # the whole space: products anew for the last digits
            space = _orthonormal(space, [locked])
            image = times(space)
            continue
        active = slice(0, open_)
        held = np.column_stack((locked, u[:, active]))

        def projected(t):
            return t - held @ (held.T @ t)

        def op(t, shift=theta[active]):
            return projected(times(t) - t * shift)

        t = minres(op, -projected(res[:, active]), p.inner, 0.02)
        t = _orthonormal(t, [locked, space])
        if not t.shape[1]:
            t = _orthonormal(rng.standard_normal((dim, 1)), [locked, space])
        space, image = np.column_stack((space, t)), np.column_stack((image, times(t)))
        # keep both orthogonal to the locked vectors in spite of rounding
        image = image - locked @ (locked.T @ image)
    else:
        raise RuntimeError(f"{p.rounds} rounds did not bring all residuals down")
    q, _ = np.linalg.qr(locked)
    image = times(q)
    h = q.T @ image
    theta, y = np.linalg.eigh((h + h.T) / 2)
    theta, y = theta[::-1], y[:, ::-1]
    vectors = q @ y
    return theta, vectors, np.linalg.norm(image @ y - vectors * theta, axis=0), calls


def fit_whitening(data: WholeVectors, p: WhiteningParams = WhiteningParams()) -> Fit:
    """Sums and leading eigenpairs of the covariance of ``whole_vectors``."""
    dim = data.dim

    def sums(x):  # in three parts, so that no sum leaves 64 bits
        return np.concatenate(([len(x)], (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))).astype(np.int64)

    got = _total(data, (1 + 2 * dim,), sums, p.fan_in)
    n = int(got[0])
    total = [(int(h) << 32) + int(w) for h, w in zip(got[1:1 + dim], got[1 + dim:])]
    fit = Fit(n, np.array([s // max(1, n) for s in total], np.int64), np.array([s % max(1, n) for s in total], np.int64),
              np.zeros(0), np.zeros((dim, 0)), 0.0, np.zeros(0), 0)
    if n < 2 or not dim:
        return fit
    fit.trace = float(_total(data, (1,), lambda x: np.array([(fit.centred(x) ** 2).sum()]), p.fan_in)[0]) / n
    if not fit.trace > 0:
        return fit

    def product(m: np.ndarray) -> np.ndarray:
        def own(x):
            d = fit.centred(x)
            return (d.T @ (d @ m)).reshape(-1)
        return _total(data, m.shape, own, p.fan_in) / n

    values, vectors, residuals, calls = jacobi_davidson(product, dim, p)
    keep = values > p.floor * values[0]
    fit.values, fit.vectors, fit.residuals, fit.products = values[keep], vectors[:, keep], residuals[keep], calls
    return fit


def identity_error(data: WholeVectors, fit: Fit, p: WhiteningParams) -> float:
    """Largest entry of the covariance of the whitened rows, less the identity."""
    k = len(fit.values)
    if not k:
        return 0.0
    mean = _total(data, (k,), lambda x: fit.project(x).sum(0), p.fan_in) / fit.n

    def own(x):
        w = fit.project(x) - mean
        return (w.T @ w).reshape(-1)

    return float(np.abs(_total(data, (k, k), own, p.fan_in) / fit.n - np.eye(k)).max())


def deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over the dimensions of ``(n x - S)**2`` of every row, exact; None beyond 64 bits."""
    y = x - fit.low
    if not len(y):
        return []
    if (fit.n * (int(np.abs(y).max()) + 1)) ** 2 * y.shape[1] < 1 << 63:
        z = fit.n * y - fit.rest
        return (z * z).sum(1).tolist()
    z = fit.n * y.astype(object) - fit.rest.astype(object)
    return [v if v < 1 << 63 else None for v in (z * z).sum(1).tolist()]


def whitened(vectors: DataFrame, p: WhiteningParams = WhiteningParams(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per
    vector and component (at most ``components``, numbered from 1 by falling eigenvalue).

    Vectors that are null or empty, or hold null or non-finite entries, take no part; nor do
    those of another length than most (of two equally frequent lengths the larger counts) or
    with entries beyond 2**51. Repeated rows and null ids are vectors like others. A
    component without variance (below 1e-12 of the largest) is not returned, so equal
    vectors, a single one and an empty table give no rows. ``deviation`` is null where it
    exceeds 64 bits. Eigenvalues that are equal have any orthonormal vectors of their space.
    """
    spark = vectors.sparkSession
    data = whole_vectors(vectors, p, id_col, vec_col)
    fit = fit_whitening(data, p)
    error = identity_error(data, fit, p)
    dim = data.dim
    shared = spark.sparkContext.broadcast(fit)  # dimensions x components numbers

    def emit(batches):
        f = shared.value
        k = len(f.values)
        part = f.values / f.trace if k else f.values
        for b in batches:
            m = b.num_rows
            if not m or not k:
                continue
            x = _matrix(b.column(1), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, f.n, np.int64)), pa.array(deviations(x, f), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(f.project(x).reshape(-1)), pa.array(np.tile(part, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return data.rows.mapInArrow(
        emit, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
