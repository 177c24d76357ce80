"""Tail probabilities as small vectorised helpers over result rows (one row per test)."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return h * scale


def _lower_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _lower_beta(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                          -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _beta_point(a: float, b: float, p: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(200):
        mid = (low + high) / 2
        if _lower_beta(a, b, mid) < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2


@F.pandas_udf(T.DoubleType())
def chi_square_tail(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) or pd.isna(k) or k <= 0 else _upper_gamma(k / 2, s / 2)
                      for s, k in zip(statistic, freedom)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def two_sided_normal(z: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else min(1.0, math.erfc(v / math.sqrt(2))) for v in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_point(u: pd.Series) -> pd.Series:
    """Inverse normal of a probability held to [1e-7, 1 - 1e-7]."""
    normal = NormalDist()
    return pd.Series([None if pd.isna(v) else normal.inv_cdf(min(1 - 1e-7, max(1e-7, v))) for v in u], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())]))
def clopper_pearson(successes: pd.Series, trials: pd.Series, confidence: pd.Series) -> pd.DataFrame:
    """Exact binomial interval."""
    lower, upper = [], []
    for k, n, level in zip(successes, trials, confidence):
        tail = (1 - level) / 2
        lower.append(0.0 if k == 0 else _beta_point(k, n - k + 1, tail))
        upper.append(1.0 if k == n else _beta_point(k + 1, n - k, 1 - tail))
    return pd.DataFrame({"lower": lower, "upper": upper})
