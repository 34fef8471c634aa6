"""Student t quantiles and confidence limits as Spark columns."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE_SIZE = 200
Z_975 = 1.959963984540054


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    out = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return out


def _t_upper_tail(t: float, df: float) -> float:
    """P(T > t) for t >= 0."""
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)) if 0.0 < x < 1.0 else 0.0
    if x < (a + 1.0) / (a + b + 2.0):
        inc = front * _beta_fraction(a, b, x) / a
    else:
        inc = 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
    return inc / 2.0


@lru_cache(maxsize=None)
def t_quantile_975(df: int) -> float:
    """97.5 % quantile of Student's t, by bisection."""
    low, high = 0.0, 20.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if _t_upper_tail(mid, df) > 0.025:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def t_975(df: Column) -> Column:
    """97.5 % t quantile of a degrees-of-freedom column; NULL below one.

    Looked up for few degrees of freedom, else the expansion in 1/df around
    the normal quantile, which is exact to about 1e-12 there.
    """
    values = ", ".join(f"{t_quantile_975(d)!r}D" for d in range(1, TABLE_SIZE + 1))
    table = F.expr(f"array({values})")
    z, v = Z_975, df.cast("double")
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    series = F.lit(z)
    for power, term in enumerate(terms, start=1):
        series = series + F.lit(term) / F.pow(v, F.lit(float(power)))
    small = F.element_at(table, F.least(df, F.lit(TABLE_SIZE)).cast("int"))
    return F.when(df < 1, None).when(df <= TABLE_SIZE, small).otherwise(series)


def logit_limits(p: Column, se: Column, t: Column) -> tuple[Column, Column]:
    """Limits of a proportion, symmetric on the logit scale.

    At 0 and 1 the logit is undefined and the estimate itself is returned.
    """
    middle = F.log(F.try_divide(p, 1 - p))
    half = t * F.try_divide(se, p * (1 - p))
    edge = (p <= 0) | (p >= 1)

    def back(x: Column) -> Column:
        return F.when(edge, p).otherwise(1 / (1 + F.exp(-x)))

    return back(middle - half), back(middle + half)


def mean_limits(p: Column, se: Column, t: Column) -> tuple[Column, Column]:
    return p - t * se, p + t * se
