"""The Shapiro-Wilk test of a bounded sample (tails as columns are in ``special``)."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_ND = NormalDist()


def _poly(c, x):
    return sum(ci * x ** i for i, ci in enumerate(c))


def shapiro_wilk(x) -> tuple[float, float]:
    """Royston (1992/1995) approximation of the Shapiro-Wilk W and its p-value."""
    x = np.sort(np.asarray(x, dtype=float))
    n = x.size
    if n < 3:
        return float("nan"), float("nan")
    rng = x[-1] - x[0]
    if rng <= 0:
        return 1.0, 1.0
    m = np.array([_ND.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    ssm = float(np.dot(m, m))
    u = 1.0 / math.sqrt(n)
    a = np.zeros(n)
    if n == 3:
        a[0] = math.sqrt(0.5)
        a[-1] = -a[0]
    else:
        an = -m[0] / math.sqrt(ssm)
        # fixed values: the published coefficients of Royston's approximation
        a_n = _poly([0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056], u) + m[-1] / math.sqrt(ssm)
        if n > 5:
            a_n1 = _poly([0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633], u) + m[-2] / math.sqrt(ssm)
            phi = (ssm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a_n ** 2 - 2 * a_n1 ** 2)
            a = m / math.sqrt(phi)
            a[-1], a[-2], a[0], a[1] = a_n, a_n1, -a_n, -a_n1
        else:
            phi = (ssm - 2 * m[-1] ** 2) / (1 - 2 * a_n ** 2)
            a = m / math.sqrt(phi)
            a[-1], a[0] = a_n, -a_n
        del an
    xc = x - x.mean()
    w = float(np.dot(a, x) ** 2 / np.dot(xc, xc))
    w = min(w, 1.0)
    if n == 3:
        p = max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
        return w, p
    ln = math.log(n)
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        mu = 0.5440 - 0.39978 * n + 0.025054 * n ** 2 - 0.0006714 * n ** 3
        sigma = math.exp(1.3822 - 0.77857 * n + 0.062767 * n ** 2 - 0.0020322 * n ** 3)
        y = -math.log(gamma - math.log1p(-w)) if gamma - math.log1p(-w) > 0 else float("inf")
    else:
        mu = -1.5861 - 0.31082 * ln - 0.083751 * ln ** 2 + 0.0038915 * ln ** 3
        sigma = math.exp(-0.4803 - 0.082676 * ln + 0.0030302 * ln ** 2)
        y = math.log1p(-w) if w < 1 else -float("inf")
    z = (y - mu) / sigma
    p = 1.0 - _ND.cdf(z) if np.isfinite(z) else (0.0 if z > 0 else 1.0)
    return w, p
