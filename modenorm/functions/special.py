"""Special functions on the handful of per-mode numbers the driver updates.

Spark SQL has no digamma or log-gamma; they are only needed on K numbers per
fit iteration, never per row, so plain Python is the right place.
"""

from __future__ import annotations

import math


def digamma(x: float) -> float:
    """psi(x) for x > 0: recurrence up to x >= 10, then the asymptotic series."""
    if x <= 0:
        raise ValueError("digamma defined here for x > 0 only")
    acc = 0.0
    while x < 10.0:
        acc -= 1.0 / x
        x += 1.0
    inv = 1.0 / x
    inv2 = inv * inv
    series = inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 * (1.0 / 240 - inv2 * (1.0 / 132)))))
    return acc + math.log(x) - 0.5 * inv - series


def gammaln(x: float) -> float:
    return math.lgamma(x)


def betaln(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
