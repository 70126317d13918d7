"""Tails of distributions that Spark has no function for, as Arrow-batched functions."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def two_sided_normal(z: pd.Series) -> pd.Series:
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2)), na_action="ignore")


@F.pandas_udf(DoubleType())
def upper_normal(z: pd.Series) -> pd.Series:
    return z.map(lambda x: 0.5 * math.erfc(x / math.sqrt(2)), na_action="ignore")


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / max(1 + term * d, 1e-300) if 1 + term * d > 0 else 1 / (1 + term * d)
        c = 1 + term / c
        f *= c * d
        if abs(1 - c * d) < 1e-13:
            break
    return front * (f - 1)


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) with df degrees of freedom."""
    if not np.isfinite(t) or df <= 0:
        return float("nan")
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def gamma_tails(a: float, x: float) -> tuple[float, float]:
    """Regularised lower and upper incomplete gamma functions, each to full relative accuracy where it is small."""
    if x <= 0:
        return 0.0, 1.0
    front = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        low = min(1.0, math.exp(front + math.log(total)))
        return low, 1 - low
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 1_000_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    high = min(1.0, math.exp(front + math.log(h)))
    return 1 - high, high


def chi_square_above(x: float, df: float) -> float:
    """P(X > x)."""
    return gamma_tails(df / 2, x / 2)[1]


@F.pandas_udf(DoubleType())
def chi_square_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) or pd.isna(b) else chi_square_above(a, b) for a, b in zip(x, df, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def _poisson_above(k: pd.Series, mean: pd.Series) -> pd.Series:
    return pd.Series([1.0 if a < 0 else gamma_tails(a + 1, b)[0] for a, b in zip(k, mean, strict=True)], dtype=float)


def poisson_above(k: Column, mean: Column) -> Column:
    """P(X > k) for a Poisson variable, exact in both tails; k is rounded down."""
    return _poisson_above(F.floor(k).cast("double"), mean.cast("double"))


def _shifted(x: Column, term: Callable[[Column], Column]) -> Column:
    total = term(x)
    for i in range(1, 8):
        total = total + term(x + i)
    return total


def digamma(x: Column) -> Column:
    """For positive x: recurrence to x + 8 and the asymptotic series there."""
    y = x + 8
    r = 1 / (y * y)
    return F.log(y) - 1 / (2 * y) - r * (F.lit(1 / 12) - r * (F.lit(1 / 120) - r * (F.lit(1 / 252) - r / 240))) - _shifted(x, lambda z: 1 / z)


def trigamma(x: Column) -> Column:
    y = x + 8
    r = 1 / (y * y)
    return 1 / y + r / 2 + r / y * (F.lit(1 / 6) - r * (F.lit(1 / 30) - r * (F.lit(1 / 42) - r / 30))) + _shifted(x, lambda z: 1 / (z * z))


@F.pandas_udf(DoubleType())
def inverse_trigamma(v: pd.Series) -> pd.Series:
    """x with trigamma(x) = v, by bisection on its logarithm; for a few values."""

    def tri(x: float) -> float:
        total = 0.0
        while x < 20:
            total, x = total + 1 / (x * x), x + 1
        r = 1 / (x * x)
        return total + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))

    def solve(v: float) -> float:
        low, high = -20.0, 40.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if tri(math.exp(middle)) > v else (low, middle)
        return math.exp((low + high) / 2)

    return v.map(solve, na_action="ignore")
