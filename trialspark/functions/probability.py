"""Distribution functions as Column expressions.

Spark SQL has no ``erf``, incomplete beta or incomplete gamma. The normal CDF,
which nearly every score needs, is plain arithmetic and takes part in
whole-stage code generation. The F, t and chi-square tails iterate, which SQL
lambdas do about a thousand times slower than numpy over Arrow batches, so they
are pandas UDFs; rows with a null input cost next to nothing there.
"""

from __future__ import annotations

from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hart's rational approximation of the normal tail in the form
# published by G. West, "Better approximations to cumulative normal functions".
_TAIL_NUMERATOR = (
    0.0352624965998911,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
_TAIL_DENOMINATOR = (
    0.0883883476483184,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
# Lanczos coefficients for g = 7, n = 9.
_LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)
_HALF_LOG_TWO_PI = 0.91893853320467274178


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_cdf(z: Column) -> Column:
    """P(Z <= z) for a standard normal Z; null for null or NaN."""
    size = F.abs(z)
    decay = F.exp(-size * size / 2)
    near = decay * _polynomial(size, _TAIL_NUMERATOR) / _polynomial(size, _TAIL_DENOMINATOR)
    fraction = size + 0.65
    for k in (4, 3, 2, 1):
        fraction = size + F.lit(float(k)) / fraction
    far = decay / fraction / 2.506628274631
    tail = F.when(size < 7.07106781186547, near).when(size <= 37, far).otherwise(F.lit(0.0))
    return F.when(z.isNull() | F.isnan(z), F.lit(None).cast("double")).when(z > 0, 1 - tail).otherwise(tail)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    series = np.full_like(x, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:]):
        series = series + c / (x + i)
    t = x + 6.5
    return _HALF_LOG_TWO_PI + (x - 0.5) * np.log(t) - t + np.log(series)


def _away_from_zero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 1e-300, 1e-300, x)


def _beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta integral by Lentz' recursion.

    It settles after a number of rounds near the square root of the larger
    parameter; rounds stop when no row moves any more.
    """
    d = 1 / _away_from_zero(1 - (a + b) * x / (a + 1))
    c, h = np.ones_like(x), d.copy()
    for m in range(1, 200 + int(10 * np.sqrt(max(a.max(), b.max())))):
        moved = np.zeros_like(x)
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / _away_from_zero(1 + step * d)
            c = _away_from_zero(1 + step / c)
            moved = np.maximum(moved, np.abs(c * d - 1))
            h = h * c * d
        if moved.max() < 1e-15:
            break
    return h


def incomplete_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b); NaN where undefined."""
    x, a, b = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(x, a, b))
    out = np.full(x.shape, np.nan)
    valid = (a > 0) & (b > 0) & ~np.isnan(x)
    out[valid & (x <= 0)] = 0.0
    out[valid & (x >= 1)] = 1.0
    inner = valid & (x > 0) & (x < 1)
    if inner.any():
        xi, ai, bi = x[inner], a[inner], b[inner]
        flip = xi > (ai + 1) / (ai + bi + 2)
        xs, as_, bs = np.where(flip, 1 - xi, xi), np.where(flip, bi, ai), np.where(flip, ai, bi)
        log_front = as_ * np.log(xs) + bs * np.log1p(-xs) + _log_gamma(as_ + bs) - _log_gamma(as_) - _log_gamma(bs)
        value = np.exp(log_front) * _beta_fraction(xs, as_, bs) / as_
        out[inner] = np.where(flip, 1 - value, value)
    return out


def _f_tail(f: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        x = np.where(f <= 0, 1.0, n / (n + m * f))
        x = np.where(np.isinf(f) & (f > 0), 0.0, x)
        return incomplete_beta(np.where(np.isnan(f), np.nan, x), n / 2, m / 2)


class Curve:
    """A smooth function on an interval as cubics between even places, from its values and slopes there; constant outside."""

    def __init__(self, low: float, high: float, values: np.ndarray, slopes: np.ndarray):
        self.low, self.high, self.per_unit = low, high, (len(values) - 1) / (high - low)
        v, w, s, r = values[:-1], values[1:], slopes[:-1] / self.per_unit, slopes[1:] / self.per_unit
        self.cubic = v.copy(), s.copy(), 3 * (w - v) - 2 * s - r, 2 * (v - w) + s + r

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Values at ``x``, which is overwritten; NaN stays NaN."""
        np.clip(x, self.low, self.high, out=x)
        x -= self.low
        x *= self.per_unit
        with np.errstate(invalid="ignore"):
            at = x.astype(np.int32)
        np.clip(at, 0, len(self.cubic[0]) - 1, out=at)
        x -= at
        out = self.cubic[3].take(at)
        for c in self.cubic[2::-1]:
            out *= x
            out += c.take(at)
        return out


@lru_cache(maxsize=1)
def log_normal_percent() -> Curve:
    """Log of 100 P(Z <= z), where that lies between 0.8 and 99.2."""
    z = np.linspace(-2.41, 2.41, 4097)
    poly = lambda c: np.polyval(c, np.abs(z))
    tail = np.exp(-z * z / 2) * poly(_TAIL_NUMERATOR) / poly(_TAIL_DENOMINATOR)
    p = np.where(z > 0, 1 - tail, tail)
    return Curve(z[0], z[-1], np.log(100 * p), np.exp(-z * z / 2) / np.sqrt(2 * np.pi) / p)


@lru_cache(maxsize=4096)
def log_f_percent(m: float, n: float, places: int = 1025) -> Curve:
    """Log of 100 P(F > exp(x)) by x, where that lies between 0.9 and 99.1, for m and n degrees of freedom."""
    tail = lambda x: _f_tail(np.exp(x), np.full(x.shape, m), np.full(x.shape, n))
    low, high = np.array([-700.0, -700.0]), np.array([700.0, 700.0])
    for _ in range(24):  # halves the intervals around both ends
        mid = (low + high) / 2
        over = tail(mid) > np.array([0.991, 0.009])
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    x = np.linspace(low[0], high[1], places)
    p, share = tail(x), n / (n + m * np.exp(x))
    a, b = n / 2, m / 2
    log_beta = float((_log_gamma(np.array([a])) + _log_gamma(np.array([b])) - _log_gamma(np.array([a + b])))[0])
    density = np.exp(a * np.log(share) + b * np.log1p(-share) - log_beta)
    return Curve(x[0], x[-1], np.log(100 * p), -density / p)


def f_tail_of_log(x: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """P(F > exp(x)) with m and n degrees of freedom; NaN where undefined."""
    with np.errstate(over="ignore"):
        return _f_tail(np.exp(x), m, n)


def _t_tail(t: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        half = incomplete_beta(n / (n + t * t), n / 2, np.full_like(n, 0.5)) / 2
        return np.where(t < 0, 1 - half, half)


def _t_quantile(level: float, n: np.ndarray) -> np.ndarray:
    """Newton steps from the normal quantile.

    The CDF is concave above zero, so the steps climb towards the root and never pass it.
    """
    out = np.full(n.shape, np.nan)
    ok = n > 0
    if ok.any():
        dof = n[ok]
        t = np.full(dof.shape, NormalDist().inv_cdf(level))
        log_k = _log_gamma((dof + 1) / 2) - _log_gamma(dof / 2) - np.log(dof * np.pi) / 2
        for _ in range(60):
            density = np.exp(log_k - (dof + 1) / 2 * np.log1p(t * t / dof))
            step = (_t_tail(t, dof) - (1 - level)) / density
            t = t + step
            if np.abs(step).max() < 1e-13 * max(1.0, np.abs(t).max()):
                break
        out[ok] = t
    return out


def _gamma_tail(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Upper regularised incomplete gamma Q(a, x): series below the mean, continued fraction above."""
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & ~np.isnan(x)
    out[ok & (x <= 0)] = 1.0
    low = ok & (x > 0) & (x < a + 1)
    if low.any():
        xs, as_ = x[low], a[low]
        term = total = 1 / as_
        for k in range(1, 200 + int(10 * np.sqrt(as_.max()))):
            term = term * xs / (as_ + k)
            total = total + term
            if (term < total * 1e-16).all():
                break
        out[low] = 1 - total * np.exp(as_ * np.log(xs) - xs - _log_gamma(as_))
    high = ok & (x >= a + 1) & np.isfinite(x)
    out[ok & np.isinf(x)] = 0.0
    if high.any():
        xs, as_ = x[high], a[high]
        base = xs + 1 - as_
        c, d = np.full_like(xs, 1e300), 1 / base
        h = d
        for k in range(1, 200 + int(10 * np.sqrt(as_.max()))):
            step = -k * (k - as_)
            base = base + 2
            d = 1 / _away_from_zero(step * d + base)
            c = _away_from_zero(base + step / c)
            h = h * c * d
            if np.abs(c * d - 1).max() < 1e-15:
                break
        out[high] = np.exp(as_ * np.log(xs) - xs - _log_gamma(as_)) * h
    return out


def _floats(*columns: pd.Series) -> list[np.ndarray]:
    return [c.to_numpy(dtype=float, na_value=np.nan) for c in columns]


@F.pandas_udf(T.DoubleType())
def _f_sf_udf(f: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(_f_tail(*_floats(f, m, n)))


@F.pandas_udf(T.DoubleType())
def _t_sf_udf(t: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(_t_tail(*_floats(t, n)))


@F.pandas_udf(T.DoubleType())
def _t_quantile_udf(level: pd.Series, n: pd.Series) -> pd.Series:
    (dof,) = _floats(n)
    return pd.Series(_t_quantile(float(level.iloc[0]), dof) if len(dof) else dof)


@F.pandas_udf(T.DoubleType())
def _chi2_sf_udf(x: pd.Series, n: pd.Series) -> pd.Series:
    value, dof = _floats(x, n)
    return pd.Series(_gamma_tail(value / 2, dof / 2))


def f_sf(value: Column, df1: Column, df2: Column) -> Column:
    """P(F > value) with ``df1`` and ``df2`` degrees of freedom; null where undefined."""
    return _f_sf_udf(value.cast("double"), df1.cast("double"), df2.cast("double"))


def t_sf(value: Column, df: Column) -> Column:
    """P(T > value) with ``df`` degrees of freedom."""
    return _t_sf_udf(value.cast("double"), df.cast("double"))


def t_two_sided(value: Column, df: Column) -> Column:
    return 2 * _t_sf_udf(F.abs(value.cast("double")), df.cast("double"))


def t_quantile(level: float, df: Column) -> Column:
    """The ``level`` quantile of Student's t, for 0.5 < level < 1."""
    return _t_quantile_udf(F.lit(float(level)), df.cast("double"))


def chi2_sf(value: Column, df: Column) -> Column:
    """P(X > value) for a chi-square X with ``df`` degrees of freedom."""
    return _chi2_sf_udf(value.cast("double"), df.cast("double"))
