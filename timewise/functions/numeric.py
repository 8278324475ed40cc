"""Numeric expressions: null-only cleaning, safe ratios, Yeo-Johnson."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """NaN and +-inf become null (the engine's null-only rule)."""
    c = _c(c).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(None).cast("double")).otherwise(c)


def finite_frame(df, cols, keep=()):
    """``df`` reduced to ``keep`` plus the given columns made finite, as one
    projection below an aggregation (so the cleaning runs once per row, not
    once per use inside each aggregate's update expressions)."""
    return df.select(*[F.col(f"`{k}`") for k in keep], *[finite(f"`{c}`").alias(c) for c in cols])


def to_number(c: Column | str) -> Column:
    """Text or number to DOUBLE; unparsable, NaN and inf become null."""
    c = _c(c)
    return finite(F.trim(c.cast("string")).try_cast("double"))


def safe_ratio(n: Column | str, d: Column | str) -> Column:
    """n / d with a zero or null denominator giving null."""
    return F.try_divide(_c(n).cast("double"), F.nullif(_c(d).cast("double"), F.lit(0.0)))


def yeo_johnson(c: Column | str, lam: float) -> Column:
    """Forward Yeo-Johnson transform with a fixed lambda."""
    x = _c(c).cast("double")
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).when(x < 0, neg)


def yeo_johnson_inverse(c: Column | str, lam: float) -> Column:
    """Inverse Yeo-Johnson; values outside the transform's range give null."""
    y = _c(c).cast("double")
    if abs(lam) < 1e-12:
        pos = F.expm1(y)
    else:
        base = y * F.lit(lam) + 1.0
        pos = F.when(base > 0, F.pow(base, F.lit(1.0 / lam)) - 1.0)
    if abs(lam - 2.0) < 1e-12:
        neg = 1.0 - F.exp(-y)
    else:
        base = 1.0 - F.lit(2.0 - lam) * y
        neg = F.when(base > 0, 1.0 - F.pow(base, F.lit(1.0 / (2.0 - lam))))
    return finite(F.when(y >= 0, pos).when(y < 0, neg))


def sample_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness from Spark's population skewness."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def sample_excess_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis from Spark's population excess kurtosis."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * g2 + 6.0))
