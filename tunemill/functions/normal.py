"""Inverse normal distribution as an expression, and the t-test p-value of a correlation."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wichura's rational approximations (Applied Statistics algorithm AS 241, PPND16),
# coefficients from the highest power down.
CENTRE = (
    [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
    [5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0],
)
SHOULDER = (
    [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734],
    [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0],
)
TAIL = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772],
    [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0],
)


def _ratio(coefficients, x: np.ndarray) -> np.ndarray:
    top, bottom = (reduce(lambda acc, c: acc * x + c, side[1:], side[0]) for side in coefficients)
    return top / bottom


@F.pandas_udf(T.DoubleType())
def _inverse_normal(shares: pd.Series) -> pd.Series:
    p = shares.to_numpy(float)
    inside = (p > 0) & (p < 1)
    p = np.where(inside, p, 0.5)
    q = p - 0.5
    r = np.sqrt(-np.log(np.minimum(p, 1.0 - p)))
    tail = np.where(r <= 5.0, _ratio(SHOULDER, r - 1.6), _ratio(TAIL, r - 5.0))
    centre = q * _ratio(CENTRE, 0.180625 - q * q)
    return pd.Series(np.where(inside, np.where(np.abs(q) <= 0.425, centre, np.sign(q) * tail), np.nan))


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile for 0 < p < 1, else null.

    Evaluated for whole Arrow batches: as one expression the three ratios are too long a method for Java to compile.
    """
    return _inverse_normal(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return total


def t_pvalue(r: float, n: int) -> float:
    """Two-sided p-value of a correlation ``r`` over ``n`` pairs."""
    if r is None or n is None or n < 3 or math.isnan(r):
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    if r * r == 0.0:
        return 1.0
    df = n - 2
    x, a, b = 1.0 - r * r, df / 2.0, 0.5
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(r * r)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def correlation_pvalue(r: pd.Series, n: pd.Series) -> pd.Series:
    """``t_pvalue`` for a result table with one row per feature."""
    return pd.Series([t_pvalue(a, b) for a, b in zip(r, n)], dtype="float64")
