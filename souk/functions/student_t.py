"""Two-sided Student-t p-values, applied to tables that are already one row per test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Degrees of freedom beyond which the expansion around the normal distribution is used.
NORMAL = 1e6


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    floor = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), floor)
    value = d
    for m in range(1, 20000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > floor else floor)
            c = c if abs(c) > floor else floor
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"the fraction for a={a}, b={b}, x={x} does not converge")


def _log_gamma_step(a: float) -> float:
    """log Gamma(a + 1/2) - log Gamma(a), by its asymptotic series where a difference of two would lose digits."""
    if a < 50:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)


def p_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if not (df > 0) or math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    if df > NORMAL:  # the normal tail and the first term of its expansion in 1 / df; the next is below 1e-12
        return math.erfc(abs(t) / math.sqrt(2)) + math.exp(-t * t / 2) / math.sqrt(2 * math.pi) * (abs(t) ** 3 + abs(t)) / (2 * df)
    a, b = df / 2.0, 0.5
    x, rest = df / (df + t * t), t * t / (df + t * t)
    if rest == 0.0:
        return 1.0
    scale = _log_gamma_step(a) - math.lgamma(b) - a * math.log1p(t * t / df) + b * math.log(rest)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(scale) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(scale) * _beta_fraction(b, a, rest) / b


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    pairs = zip(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan))
    return pd.Series([p_two_sided(a, b) for a, b in pairs], dtype=float).where(lambda p: p.notna(), None)
