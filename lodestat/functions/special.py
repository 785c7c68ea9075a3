"""Tail probabilities, quantiles and zeta sums for single numbers.

They finish results of a few rows (coefficient tables, one row per group); the
data pass is always Spark's.
"""

from __future__ import annotations

import math

import numpy as np

_GL_X, _GL_W = np.polynomial.legendre.leggauss(32)


# --- normal ------------------------------------------------------------------------

def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Quantile by bisection on the tail function."""
    return _invert(norm_cdf, p, -40.0, 40.0)


def _invert(cdf, p: float, lo: float, hi: float) -> float:
    for _ in range(200):
        mid = (lo + hi) / 2
        if cdf(mid) < p:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-14 * max(1.0, abs(mid)):
            break
    return (lo + hi) / 2


# --- incomplete beta and gamma ----------------------------------------------------------

def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    f = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * f


def gamma_inc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > 1e-17 * abs(total):
            n += 1
            term *= x / n
            total += term
        return 1.0 - scale * total
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b if abs(an * d + b) > tiny else tiny)
        c = b + an / c if abs(b + an / c) > tiny else tiny
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return scale * h


def t_tail(t: float, df: float) -> float:
    """Two-sided tail of Student's t."""
    return beta_inc(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def t_ppf(p: float, df: float) -> float:
    def cdf(t):
        half = t_tail(t, df) / 2
        return 1 - half if t > 0 else half
    return _invert(cdf, p, -1e6, 1e6)


def f_tail(f: float, d1: float, d2: float) -> float:
    """Upper tail of F."""
    return 1.0 if f <= 0 else beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def chi2_tail(x: float, df: float) -> float:
    return gamma_inc_upper(df / 2, x / 2)


# --- studentised range -------------------------------------------------------------------

_erf = np.vectorize(math.erf)


def _phi(z):
    return 0.5 * (1 + _erf(z / math.sqrt(2)))


def _range_cdf(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals <= w)."""
    out = np.zeros_like(w)
    edges = np.linspace(-8.0, 8.0, 9)
    for lo, hi in zip(edges[:-1], edges[1:]):
        z = (hi - lo) / 2 * _GL_X + (hi + lo) / 2
        weight = (hi - lo) / 2 * _GL_W * np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        inside = np.clip(_phi(z[None, :]) - _phi(z[None, :] - w[:, None]), 0, 1)
        out += k * (weight[None, :] * inside ** (k - 1)).sum(axis=1)
    return np.minimum(out, 1.0)


def tukey_tail(q: float, k: int, df: float) -> float:
    """Upper tail of the studentised range of ``k`` means with ``df`` error degrees of freedom."""
    if q <= 0:
        return 1.0
    if df > 1e5:
        return float(1 - _range_cdf(np.array([q]), k)[0])
    # s = sqrt(chi2_df / df): density over the range that carries its mass
    sd = 1 / math.sqrt(2 * df)
    lo, hi = max(1e-9, 1 - 9 * sd), 1 + 9 * sd + 4 / df
    edges = np.linspace(lo, hi, 9)
    log_c = (df / 2) * math.log(df / 2) + math.log(2) - math.lgamma(df / 2)
    total = 0.0
    for a, b in zip(edges[:-1], edges[1:]):
        s = (b - a) / 2 * _GL_X + (b + a) / 2
        dens = np.exp(log_c + (df - 1) * np.log(s) - df * s * s / 2)
        total += float(((b - a) / 2 * _GL_W * dens * (1 - _range_cdf(q * s, k))).sum())
    return min(max(total, 0.0), 1.0)


# --- zeta sums -------------------------------------------------------------------------------

# Summed term by term up to here, by Euler-Maclaurin beyond.
_DIRECT = 2000


def power_sums(gamma: float, delta: float, n: float, weights: int = 0) -> np.ndarray:
    """Sums over k = 1..n of f, f ln k, f k, f ln^2 k, f k ln k, f k^2 with f = k^-gamma e^(-delta k).

    Only the first is returned when ``weights`` is 0, the first three when 1, all when 2.
    ``n`` may be infinite for gamma > 1 or delta > 0.
    """
    count = (1, 3, 6)[weights]

    def terms(k):
        f = np.exp(-gamma * np.log(k) - delta * k)
        lk = np.log(k)
        return np.stack([f, f * lk, f * k, f * lk * lk, f * k * lk, f * k * k][:count])

    m = int(min(n, _DIRECT))
    total = terms(np.arange(1, m + 1, dtype=float)).sum(axis=1)
    if n <= _DIRECT:
        return total
    # integral from m to n in u = ln k, cut where the tail no longer counts
    top = math.log(n) if math.isfinite(n) else math.log(m) + 60.0 / max(gamma - 1, 1e-9) + 5.0
    if delta > 0:
        top = min(top, math.log(max(m + 1.0, m + 750.0 / delta)))
    edges = np.linspace(math.log(m), top, max(2, int(8 * (top - math.log(m))) + 2))
    half = np.diff(edges)[:, None] / 2
    u = half * _GL_X[None, :] + (edges[:-1, None] + half)
    k = np.exp(np.minimum(u, 700.0)).ravel()
    w = (half * _GL_W[None, :]).ravel() * k
    with np.errstate(over="ignore", invalid="ignore"):
        total = total + np.nan_to_num(terms(k) * w[None, :]).sum(axis=1)

    def edge(x):
        h = x * 1e-4
        return terms(np.array([x]))[:, 0], (terms(np.array([x + h]))[:, 0] - terms(np.array([x - h]))[:, 0]) / (2 * h)

    f_m, d_m = edge(float(m))
    total = total - f_m / 2 - d_m / 12
    if math.isfinite(n):
        f_n, d_n = edge(float(n))
        total = total + f_n / 2 + d_n / 12
    return total


def zeta(gamma: float) -> float:
    return float(power_sums(gamma, 0.0, math.inf)[0]) if gamma > 1.05 else _zeta_near_one(gamma)


def _zeta_near_one(gamma: float) -> float:
    m = _DIRECT
    k = np.arange(1, m, dtype=float)
    head = float((k ** -gamma).sum())
    return head + m ** (1 - gamma) / (gamma - 1) + 0.5 * m ** -gamma + gamma * m ** (-gamma - 1) / 12


def minimise(fn, lo: float, hi: float, tol: float = 1e-11) -> float:
    """Golden-section minimum of a function with a single dip."""
    ratio = (math.sqrt(5) - 1) / 2
    a, b = lo, hi
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = fn(c), fn(d)
    while b - a > tol * max(1.0, abs(a) + abs(b)):
        if fc < fd:
            b, d, fd = d, c, fc
            c = b - ratio * (b - a)
            fc = fn(c)
        else:
            a, c, fc = c, d, fd
            d = a + ratio * (b - a)
            fd = fn(d)
    return (a + b) / 2
