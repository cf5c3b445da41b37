"""Driver-side constants for power analysis.

Power of the chi-square and two-sided z tests depends on the sample size only
through the noncentrality ``nc``, so ``nc(alpha, power, df)`` is solved once
here (a scalar, no data involved) and every per-row sample size becomes a
column expression ``n = nc / effect**2`` (times 2 for two groups)."""

from __future__ import annotations

import math
from statistics import NormalDist

_N = NormalDist()


def _gamma_q(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0:
        return 1.0
    if x < s + 1:  # series for P, then Q = 1 - P
        term = total = 1.0 / s
        a = s
        for _ in range(10_000):
            a += 1
            term *= x / a
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return 1.0 - total * math.exp(-x + s * math.log(x) - math.lgamma(s))
    # continued fraction (modified Lentz)
    tiny = 1e-300
    b = x + 1 - s
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - s)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return math.exp(-x + s * math.log(x) - math.lgamma(s)) * h


def chi2_sf(x: float, df: float) -> float:
    return _gamma_q(df / 2.0, x / 2.0)


def ncx2_sf(x: float, df: float, nc: float) -> float:
    """Noncentral chi-square tail as a Poisson mixture of central tails."""
    if df == 1:
        r, s = math.sqrt(nc), math.sqrt(x)
        return _N.cdf(r - s) + _N.cdf(-r - s)
    lam = nc / 2.0
    total, j = 0.0, 0
    while True:
        w = math.exp(-lam + j * math.log(lam) - math.lgamma(j + 1)) if lam > 0 else (1.0 if j == 0 else 0.0)
        total += w * chi2_sf(x, df + 2 * j)
        if j > lam and w < 1e-17:
            break
        j += 1
    return total


def _bisect(f, lo: float, hi: float, iters: int = 200) -> float:
    for _ in range(iters):
        mid = (lo + hi) / 2
        if f(mid) > 0:
            hi = mid
        else:
            lo = mid
    return (lo + hi) / 2


def chi2_isf(alpha: float, df: float) -> float:
    """Critical value c with P(chi2_df > c) = alpha."""
    if df == 1:
        return _N.inv_cdf(1 - alpha / 2) ** 2
    return _bisect(lambda c: alpha - chi2_sf(c, df), 0.0, 1e4)


def noncentrality(alpha: float = 0.05, power: float = 0.8, df: int = 1) -> float:
    """nc such that a chi-square test with ``df`` degrees of freedom at level
    ``alpha`` has the requested power; df 1 is also the two-sided z test."""
    crit = chi2_isf(alpha, df)
    return _bisect(lambda nc: ncx2_sf(crit, df, nc) - power, 0.0, 1e4)
