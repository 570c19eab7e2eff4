"""Silhouettes from cluster moments against all pairs."""

import numpy as np
import pytest

from sparkaudit.operators import clusters, models


def _brute(x, own):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        others = [d[i, own == c].mean() for c in set(own.tolist()) - {own[i]}]
        a = d[i, mine].sum() / max(mine.sum() - 1, 1)
        out.append(0.0 if mine.sum() == 1 else (min(others) - a) / max(a, min(others)))
    return float(np.mean(out))


def test_silhouettes_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 0.7, size=(40, 3)) for m in (0, 3, 6)] + [np.full((1, 3), 60.0)])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(999, None)], "id int, v array<double>").repartition(4)
    centres = {2: x[[0, 50]], 3: x[[0, 50, 100]], 4: x[[0, 50, 100, 120]], 1: x[[0]]}
    got = {r.k: r for r in clusters.silhouettes(df, "v", {k: c.tolist() for k, c in centres.items()}).collect()}
    for k in (2, 3, 4):
        d = ((x[:, None] - centres[k][None]) ** 2).sum(2)
        assert got[k].silhouette == pytest.approx(_brute(x, d.argmin(1)), rel=1e-9)
        assert got[k].cost == pytest.approx(d.min(1).sum())
    assert got[1].silhouette is None


def test_scan_finds_the_planted_number(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 0.2, size=(30, 2)) for m in ((0, 0), (5, 0), (0, 5), (5, 5))])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>")
    found = {r.k: r for r in models.kmeans_scan(df, "v", range(2, 7)).collect()}
    assert [k for k, r in found.items() if r.is_best] == [4] and found[4].silhouette > 0.95


def test_no_vectors(spark):
    df = spark.createDataFrame([(None,)], "v array<double>")
    assert clusters.silhouettes(df, "v", {2: [[0.0], [1.0]]}).count() == 0
