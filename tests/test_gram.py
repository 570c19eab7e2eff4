"""Sums over pairs of columns against numpy, and plans with hundreds of columns."""

import time

import numpy as np
import pytest

from sparkaudit.functions import gram
from sparkaudit.operators import linear, signal


def _values(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) + np.array([0, 1e8, -5, 0, 3])
    x[:, 3] = 2 * x[:, 0] + 0.1 * x[:, 3]
    x[:, 4] = 7.3
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 1] = np.sort(x[:, 1])  # parts of the table differ in their means
    return x


@pytest.fixture(scope="module")
def frame(spark):
    x = _values()
    rows = [(int(i % 3), *[None if np.isnan(v) and i % 2 else float(v) for v in r]) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "g int, a double, b double, c double, d double, e double").repartition(7)


def _corr(x, i, j):
    both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
    a, b = x[both, i], x[both, j]
    return None if not both.any() or a.min() == a.max() or b.min() == b.max() else np.corrcoef(a, b)[0, 1]


def test_pairwise_correlations(frame):
    x, df = frame
    names = list("abcde")
    got = {(r.x, r.y): r.r for r in gram.correlations(gram.pair_sums(df, names), names).collect()}
    assert len(got) == 25
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            want = _corr(x, i, j)
            assert got[a, b] is None if want is None else got[a, b] == pytest.approx(want, abs=1e-9)


def test_sums_per_group(frame):
    x, df = frame
    group = np.arange(len(x)) % 3
    for r in gram.pair_sums(df, ["a", "d"], ["g"]).collect():
        own = x[group == r.g][:, [0, 3]]
        both = ~np.isnan(own).any(1)
        assert r.n[1 - r.i] == both.sum()
        mean = r.first[1 - r.i] / r.n[1 - r.i] + r.centre[r.i]
        assert mean == pytest.approx(own[both, r.i].mean())


def test_empty_and_missing_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {(r.x, r.y): r.r for r in signal.correlation_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}
    assert signal.correlation_matrix(df.where("a > 5"), ["a", "b"]).count() == 0
    assert linear.fold_moments(df, ["a"], "b", ["a"]).count() == 0


def test_hundreds_of_columns_plan_in_seconds(spark):
    width = 300
    x = np.random.default_rng(2).normal(size=(200, width))
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame([(0, i % 2, *map(float, r)) for i, r in enumerate(x)], "seed int, fold int, " + ", ".join(f"{n} double" for n in names))
    start = time.time()
    plan = signal.correlation_matrix(df, names)._jdf.queryExecution().executedPlan().toString()
    assert time.time() - start < 20 and plan
    got = {(r.x, r.y): r.r for r in signal.correlation_matrix(df, names).where("x = 'c7'").collect()}
    want = np.corrcoef(x.T)[7]
    assert all(got["c7", f"c{j}"] == pytest.approx(want[j], abs=6e-4) for j in range(width))
    fitted = linear.ridge_cv(df, names[:-1], names[-1], leave_out=False).collect()
    train = np.arange(200) % 2 == 1
    m = x[train].mean(0)
    beta = np.linalg.solve((x[train] - m)[:, :-1].T @ (x[train] - m)[:, :-1] + np.eye(width - 1), (x[train] - m)[:, :-1].T @ (x[train] - m)[:, -1])
    assert [r for r in fitted if r.fold == 0][0].coefs == pytest.approx(beta.tolist(), abs=1e-8)
