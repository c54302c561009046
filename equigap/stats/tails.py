"""Student t and F upper tails without scipy.

Both reduce to the regularised incomplete beta function I_x(a, b), evaluated
with the classic continued fraction (modified Lentz).  The Column wrappers are
Arrow ``pandas_udf``s: they only ever run on aggregated rows (one per test),
never on fact rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_sf2(t: float | None, df: float | None) -> float | None:
    """Two-sided p-value of Student t with ``df`` degrees of freedom."""
    if t is None or df is None or not np.isfinite(df) or df <= 0 or np.isnan(t):
        return None
    if np.isinf(t):
        return 0.0
    return float(betainc_reg(df / 2.0, 0.5, df / (df + t * t)))


def f_sf(f: float | None, d1: float | None, d2: float | None) -> float | None:
    """Upper tail P(F > f) of the F distribution."""
    if f is None or d1 is None or d2 is None or np.isnan(f) or d1 <= 0 or d2 <= 0:
        return None
    if f <= 0:
        return 1.0
    if np.isinf(f):
        return 0.0
    return float(betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)))


def _vec(fn, *cols: pd.Series) -> pd.Series:
    out = [fn(*[None if pd.isna(v) else float(v) for v in vals]) for vals in zip(*cols)]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(t_sf2, t, df)


@F.pandas_udf(DoubleType())
def _f_p_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p of a t statistic (Column), for aggregated rows."""
    return _t_p_udf(t.cast("double"), df.cast("double"))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    """Upper-tail p of an F statistic (Column), for aggregated rows."""
    return _f_p_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))
