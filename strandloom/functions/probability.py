"""Distribution functions for p-values, in plain Python: they run on a handful of statistics, never on rows."""

from __future__ import annotations

import math


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - betainc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    safe = lambda v: v if abs(v) > 1e-300 else 1e-300
    c, d = 1.0, 1 / safe(1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / safe(1 + num * d), safe(1 + num / c)
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def t_two_sided(t: float, df: float) -> float:
    return betainc(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def f_upper(f: float, d1: float, d2: float) -> float:
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_upper(x: float, df: float) -> float:
    return gammainc_upper(df / 2, x / 2)


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def binomial_two_sided(k: int, n: int, p: float = 0.5) -> float:
    """Sum of the probabilities that are no larger than that of k."""
    logs = [_log_choose(n, i) + (i * math.log(p) if i else 0) + ((n - i) * math.log1p(-p) if n - i else 0) for i in range(n + 1)]
    return min(1.0, sum(math.exp(x) for x in logs if x <= logs[k] + 1e-7))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Fisher's exact test on a 2 by 2 table: tables no likelier than the one seen."""
    r, s, n = a + b, a + c, a + b + c + d
    lo, hi = max(0, r + s - n), min(r, s)
    logs = {i: _log_choose(s, i) + _log_choose(n - s, r - i) - _log_choose(n, r) for i in range(lo, hi + 1)}
    return min(1.0, sum(math.exp(x) for x in logs.values() if x <= logs[a] + 1e-7))


def hypergeometric_upper(a: int, r: int, s: int, n: int) -> float:
    """Chance of at least a common members of sets of r and s out of n."""
    return min(1.0, sum(math.exp(_log_choose(s, i) + _log_choose(n - s, r - i) - _log_choose(n, r)) for i in range(a, min(r, s) + 1)))
