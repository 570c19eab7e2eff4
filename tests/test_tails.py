"""Tail functions against published values and the math library of the JVM."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkaudit.functions import tails
from sparkaudit.operators import significance


def test_t_tail_matches_library(spark):
    dist = spark._jvm.org.apache.commons.math3.distribution.TDistribution
    for df in (1.0, 4.0, 24.0, 300.5):
        for t in (-3.2, -0.1, 0.0, 0.7, 2.776, 12.0):
            assert tails.t_sf(t, df) == pytest.approx(1 - dist(df).cumulativeProbability(t), abs=1e-10)


def test_f_and_chi2_tails_match_library(spark):
    f = spark._jvm.org.apache.commons.math3.distribution.FDistribution
    c = spark._jvm.org.apache.commons.math3.distribution.ChiSquaredDistribution
    for x in (0.1, 1.0, 2.5, 9.0):
        assert tails.f_sf(x, 3.0, 40.0) == pytest.approx(1 - f(3.0, 40.0).cumulativeProbability(x), abs=1e-10)
        assert tails.chi2_sf(x, 5.0) == pytest.approx(1 - c(5.0).cumulativeProbability(x), abs=1e-10)


def test_infinite_t():
    assert tails.t_sf(math.inf, 4) == 0.0
    assert tails.t_sf(-math.inf, 4) == 1.0


def test_shapiro_published_example():
    # eleven weights of men, the example of the original paper: W = 0.79
    w, p = tails.shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.7888, abs=2e-3)
    assert p == pytest.approx(0.0067, abs=5e-4)


def test_shapiro_edges():
    assert tails.shapiro_wilk([1.0, 1.0, 1.0, 1.0]) == (1.0, 1.0)
    w, p = tails.shapiro_wilk([1.0, 2.0, 3.0])
    assert w == pytest.approx(1.0) and p == pytest.approx(1.0, abs=1e-6)
    normal = [tails._NORMAL.inv_cdf((i + 0.5) / 60) for i in range(60)]
    assert tails.shapiro_wilk(normal)[1] > 0.9
    assert tails.shapiro_wilk([math.exp(2 * x) for x in normal])[1] < 1e-4


def test_signed_rank_exact_small():
    # n = 3: P(W+ >= 6) = 1/8, P(W+ >= 5) = 2/8
    assert tails.signed_rank_sf(6, 3, 0, 0) == pytest.approx(1 / 8)
    assert tails.signed_rank_sf(5, 3, 0, 0) == pytest.approx(2 / 8)
    exact = tails.signed_rank_sf(900, 50, 0, 0)
    normal = tails.signed_rank_sf(900, 50, 0, 1)
    assert exact == pytest.approx(normal, abs=5e-3)


def test_normal_quantile_is_exact(spark):
    points = [1e-300, 1e-20, 1e-6, 0.01, 0.07, 0.075, 0.2, 0.5, 0.8, 0.9251, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    got = [r[0] for r in df.select(tails.normal_quantile(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in points], rel=1e-13, abs=1e-15)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 25, 5000])
def test_normality_from_ranks_equals_the_list_form(spark, n):
    rng = random.Random(n)
    groups = {
        "normal": [rng.gauss(0, 1) for _ in range(n)], "skewed": [math.exp(rng.gauss(0, 1)) for _ in range(n)],
        "heavy": [0.0 if i % 3 else rng.gauss(0, 1) for i in range(n)], "shifted": [1e6 + rng.gauss(0, 1) for _ in range(n)],
    }
    rows = [(g, i, x) for g, xs in groups.items() for i, x in enumerate(xs)]
    rows += [("normal", -1, None), ("flat", 0, 2.0), ("flat", 1, 2.0), ("flat", 2, 2.0), ("few", 0, 1.0), ("few", 1, 3.0)]
    got = {r.g: r for r in significance.normality(spark.createDataFrame(rows, "g string, i int, d double"), ["g"]).collect()}
    for g, xs in groups.items():
        w, p = tails.shapiro_wilk(xs)
        assert got[g].n == n
        assert (got[g].w, got[g].p_norm) == (pytest.approx(w, rel=1e-7), pytest.approx(p, rel=1e-4, abs=1e-12))
    assert got["flat"].p_norm == got["few"].p_norm == 1.0


def test_normality_of_many_values(spark):
    df = spark.range(100_000).select(
        F.lit("g").alias("g"), tails.normal_quantile((F.col("id") + 0.5) / 100_000).alias("d")
    ).unionByName(spark.range(100_000).select(F.lit("u").alias("g"), (F.col("id") % 70_000 / 1e5).alias("d")))
    got = {r.g: r for r in significance.normality(df, ["g"]).collect()}
    ends = np.array([NormalDist().inv_cdf((i + 0.5) / 100_000) for i in range(100_000)])
    assert got["g"].w == pytest.approx(tails.shapiro_wilk(ends)[0], rel=1e-9) and got["g"].w > 0.9999
    assert got["u"].w == pytest.approx(tails.shapiro_wilk(np.arange(100_000) % 70_000 / 1e5)[0], rel=1e-9) and got["u"].p_norm < 1e-9
