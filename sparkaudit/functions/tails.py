"""Tail probabilities for summary rows (one per test, never per data row).

Continued fractions for the incomplete beta and gamma functions, an exact count
for the signed-rank statistic, and Royston's normality test.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_NORMAL = NormalDist()
_TINY = 1e-300


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = c if abs(c) > _TINY else _TINY
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_regularized(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def gamma_upper_regularized(a: float, x: float) -> float:
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - front * total
    b = x + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h


def t_sf(t: float, df: float) -> float:
    """P(T > t)."""
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    half = 0.5 * beta_regularized(df / 2.0, 0.5, df / (df + t * t))
    return half if t >= 0 else 1.0 - half


def f_sf(f: float, d1: float, d2: float) -> float:
    return beta_regularized(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_sf(x: float, df: float) -> float:
    return gamma_upper_regularized(df / 2.0, x / 2.0)


def signed_rank_sf(w: float, n: int, ties: float, zeros: int) -> float:
    """P(W+ >= w): exact for up to 50 untied differences, else the normal tail."""
    if n == 0:
        return math.nan
    if n <= 50 and ties == 0 and zeros == 0:
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1.0
        for r in range(1, n + 1):
            ways[r:] = ways[r:] + ways[:-r].copy()
        return float(ways[int(math.ceil(w)):].sum() / ways.sum())
    mean = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - ties / 48.0
    return normal_sf((w - mean) / math.sqrt(var)) if var > 0 else math.nan


# fixed values: published polynomial coefficients of the normality test, highest power first
LAST_WEIGHT = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0)
SECOND_WEIGHT = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0)
SMALL_GAMMA = (0.459, -2.273)
SMALL_MEAN = (-0.0006714, 0.025054, -0.39978, 0.5440)
SMALL_LOG_SD = (-0.0020322, 0.062767, -0.77857, 1.3822)
LARGE_MEAN = (0.0038915, -0.083751, -0.31082, -1.5861)
LARGE_LOG_SD = (0.0030302, -0.082676, -0.4803)


def shapiro_weights(n: int, mm: float, last_score: float, second_score: float) -> tuple[float, float, float]:
    """Weights of the largest and the second largest of ``n`` values and the factor of all normal scores between.

    ``mm`` is the sum of squared scores. Up to five values only the ends have weights of
    their own; the second weight is then that of its score.
    """
    if n == 3:
        return math.sqrt(0.5), 0.0, 0.0
    u = 1.0 / math.sqrt(n)
    last = float(np.polyval(LAST_WEIGHT, u)) + last_score / math.sqrt(mm)
    if n <= 5:
        scale = math.sqrt((1 - 2 * last**2) / (mm - 2 * last_score**2))
        return last, second_score * scale, scale
    second = float(np.polyval(SECOND_WEIGHT, u)) + second_score / math.sqrt(mm)
    rest = mm - 2 * last_score**2 - 2 * second_score**2
    return last, second, math.sqrt((1 - 2 * last**2 - 2 * second**2) / rest) if rest > 0 else 0.0


def shapiro_from_sums(n, mm, mx, ss, low, low2, high2, high, last_score, second_score) -> float:
    """W from sums over ranked values: ``mx`` is the sum of score times value, ``low`` to ``high`` are the ends, all around the mean."""
    n = int(n)
    if n < 3 or high - low < 1e-19 or ss == 0.0:
        return 1.0
    last, second, scale = shapiro_weights(n, mm, last_score, second_score)
    if n == 3:
        return min((last * (high - low)) ** 2 / ss, 1.0)
    inner = mx - last_score * (high - low) - second_score * (high2 - low2)
    return min((inner * scale + last * (high - low) + second * (high2 - low2)) ** 2 / ss, 1.0)


def shapiro_tail(w: float, n: float) -> float:
    """p of W by Royston's normal approximation; W = 1 counts as normal."""
    n = int(n)
    if n < 3 or w >= 1.0:
        return 1.0
    if n == 3:
        return max(6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))), 0.0)
    if n <= 11:
        edge = np.polyval(SMALL_GAMMA, n) - math.log1p(-w)
        if edge <= 0.0:
            return 1e-19
        z = (-math.log(edge) - np.polyval(SMALL_MEAN, n)) / math.exp(np.polyval(SMALL_LOG_SD, n))
    else:
        ln = math.log(n)
        z = (math.log1p(-w) - np.polyval(LARGE_MEAN, ln)) / math.exp(np.polyval(LARGE_LOG_SD, ln))
    return normal_sf(float(z))


def shapiro_wilk(values) -> tuple[float, float]:
    """(W, p) of a list of at least 3 values; constant data count as normal."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3:
        return 1.0, 1.0
    x = x - x.mean()
    m = np.array([_NORMAL.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    w = shapiro_from_sums(n, float((m * m).sum()), float((m * x).sum()), float((x * x).sum()), x[0], x[1], x[-2], x[-1], m[-1], m[-2])
    return w, shapiro_tail(w, n)


# fixed values: published rational approximation of the normal quantile, lowest power first
CENTRE_TOP = (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
              45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727)
CENTRE_BOTTOM = (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
                 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610)
MIDDLE_TOP = (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
              1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640)
MIDDLE_BOTTOM = (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
                 0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9)
TAIL_TOP = (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
            0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
TAIL_BOTTOM = (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
               0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def normal_quantile(p: Column) -> Column:
    """Quantile of the normal distribution as a built-in expression, to about sixteen digits."""

    def ratio(top, bottom, x):
        level = lambda powers: reduce(lambda t, c: t * x + c, map(F.lit, reversed(powers)))
        return level(top) / level(bottom)

    q = p - 0.5
    tail = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(1 - p)))
    far = F.when(tail <= 5, ratio(MIDDLE_TOP, MIDDLE_BOTTOM, tail - 1.6)).otherwise(ratio(TAIL_TOP, TAIL_BOTTOM, tail - 5.0))
    return F.when(F.abs(q) <= 0.425, q * ratio(CENTRE_TOP, CENTRE_BOTTOM, 0.180625 - q * q)).otherwise(F.signum(q) * far)


def _vector(fn):
    def run(*series: pd.Series) -> pd.Series:
        out = [
            None if any(v is None or v != v for v in row) else fn(*(float(v) for v in row))
            for row in zip(*series)
        ]
        return pd.Series(out, dtype="float64")

    return run


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vector(t_sf)(t, df)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vector(f_sf)(f, d1, d2)


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return _vector(chi2_sf)(x, df)


@F.pandas_udf(DoubleType())
def signed_rank_tail(w: pd.Series, n: pd.Series, ties: pd.Series, zeros: pd.Series) -> pd.Series:
    return _vector(lambda a, b, c, d: signed_rank_sf(a, int(b), c, int(d)))(w, n, ties, zeros)


@F.pandas_udf(DoubleType())
def shapiro_w(n: pd.Series, mm: pd.Series, mx: pd.Series, ss: pd.Series, low: pd.Series, low2: pd.Series,
              high2: pd.Series, high: pd.Series, last_score: pd.Series, second_score: pd.Series) -> pd.Series:
    return _vector(shapiro_from_sums)(n, mm, mx, ss, low, low2, high2, high, last_score, second_score)


@F.pandas_udf(DoubleType())
def shapiro_p(w: pd.Series, n: pd.Series) -> pd.Series:
    return _vector(shapiro_tail)(w, n)
