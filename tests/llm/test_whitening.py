import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from strata.llm.queries import op11_whitened_embeddings
from strata.llm.whitening import WhiteningParams, jacobi_davidson, minres, whitened
from tests.llm.cases import SF, clashing

COLS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def vec(spark, rows, kind=DoubleType()):
    return spark.createDataFrame(rows, StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(kind))]))


def check(df, rows, components=8):
    """Against the dense covariance of the whole numbers, summed exactly."""
    assert df.columns == COLS
    got = sorted(df.collect(), key=lambda r: (str(r.vec_id), r.component))
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(c) for c in zip(*x)]
    y = np.array([[float(n * a - b) / n for a, b in zip(v, s)] for v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    keep = e > 1e-12 * e[0]
    e, u = e[keep], u[:, keep]
    w = y @ u / np.sqrt(e)
    order = sorted(range(n), key=lambda i: str(rows[i][0]))
    assert len(got) == n * len(e)
    mine = np.array([r.whitened for r in got]).reshape(n, len(e))
    for j in range(len(e)):
        sign = np.sign(mine[:, j] @ w[order, j])
        gap = min([abs(e[j] - v) for i, v in enumerate(np.linalg.eigvalsh(y.T @ y / n)[::-1][:components + 1]) if i != j] or [1]) / e[0]
        assert np.abs(sign * mine[:, j] - w[order, j]).max() < 1e-12 * max(1, np.abs(w).max()) / max(gap, 1e-9), j
    assert [r.component for r in got[:len(e)]] == list(range(1, len(e) + 1))
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    assert [r.deviation for r in got[::len(e)]] == [dev[i] if dev[i] < 2 ** 63 else None for i in order]
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    total = np.trace(y.T @ y / n)
    assert np.allclose([r.explained for r in got[:len(e)]], e / total, rtol=1e-10)
    assert np.abs(mine.T @ mine / n - np.eye(len(e))).max() < 1e-9


def test_query_equals_the_dense_solution(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(op11_whitened_embeddings(spark, SF), rows)


@pytest.mark.parametrize("fan_in, parts", [(256, 1), (2, 9)])
def test_tasks_add_up_alike(spark, fan_in, parts):
    rng = np.random.default_rng(parts)
    rows = [(i, (rng.standard_normal(11) * np.arange(1, 12) * 0.3).tolist()) for i in range(80)]
    check(whitened(vec(spark, rows).repartition(parts), WhiteningParams(fan_in=fan_in)), rows)


def test_a_large_common_offset_costs_no_digit(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (1e6 + rng.standard_normal(6) * [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]).tolist()) for i in range(200)]
    check(whitened(vec(spark, rows)), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i % 20, rng.standard_normal(4).tolist()) for i in range(20)] + [(None, [0.5, 0.25, -1.0, 2.0]), (7_000, [0.0] * 4)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("inf")] * 4),
           (104, [1.0, 2.0]), (105, []), (106, [1e300, 0.0, 0.0, 0.0]), (None, None)]
    df = clashing(vec(spark, bad + good)).withColumn("x", F.lit("x")).withColumn("v", F.lit(1)).withColumn("component", F.lit(1))
    check(whitened(df), good)


def test_floats_are_scaled_in_double_precision(spark):
    rows = [(i, [float(np.float32(0.1 * i)), float(np.float32(0.3) * i * i)]) for i in range(30)]
    check(whitened(vec(spark, rows, FloatType())), rows)


def test_too_large_deviations_are_null(spark):
    rows = [(i, [float(2 ** 30 * (i == 3)), float(i)]) for i in range(40)]
    check(whitened(vec(spark, rows)), rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [3.0, 4.0]) for i in range(9)], [(1, None)]])
def test_without_variance_there_is_no_component(spark, rows):
    df = whitened(vec(spark, rows))
    assert df.columns == COLS and df.count() == 0


def test_a_flat_direction_is_left_out(spark):
    rows = [(i, [float(i), float(-i), 1.0]) for i in range(12)]
    df = whitened(vec(spark, rows))
    assert {r.component for r in df.collect()} == {1}


@pytest.mark.parametrize("dim", [1, 5, 12, 64, 200])
def test_solver_reaches_double_precision(dim):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    for d in (np.linspace(0, 1, dim) ** 3, 0.9 ** np.arange(dim), np.concatenate((np.full(dim // 2, 5.0), np.linspace(0, 1, dim - dim // 2)))):
        v = q * d @ q.T
        v = (v + v.T) / 2
        values, vectors, res, _ = jacobi_davidson(lambda m: v @ m, dim, WhiteningParams())
        k = min(8, dim)
        top = np.linalg.eigvalsh(v)[::-1]
        assert np.abs(values - top[:k]).max() <= 1e-13 * top[0]
        assert res.max() <= 1e-12 * top[0]
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(9)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 3))
    assert np.allclose(minres(lambda t: a @ t, b, 60, 1e-13), np.linalg.solve(a, b), atol=1e-7)
