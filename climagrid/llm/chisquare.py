"""The chi-square distribution, by the series of the lower incomplete gamma function."""

from __future__ import annotations

import math


def cdf(x: float, degrees: float) -> float:
    """The probability of a value up to ``x``."""
    if x <= 0:
        return 0.0
    a, y = degrees / 2, x / 2
    if y > a + 200 + 10 * math.sqrt(a):
        return 1.0
    term = total = 1 / a
    n = 1
    while term > total * 1e-16:
        term *= y / (a + n)
        total += term
        n += 1
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a)))


def quantile(p: float, degrees: float) -> float:
    """The value that is not exceeded with probability ``p`` (below 1)."""
    low, high = 0.0, degrees + 10
    while cdf(high, degrees) < p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if cdf(middle, degrees) < p:
            low = middle
        else:
            high = middle
    return high
