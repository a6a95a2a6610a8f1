"""Student-t quantile as a driver scalar (no SciPy needed)."""

from __future__ import annotations

import math


def _t_tail(t: float, df: int) -> float:
    """P(T > t) for t >= 0 by the finite trigonometric series for integer df."""
    theta = math.atan2(t, math.sqrt(df))
    c, s = math.cos(theta), math.sin(theta)
    if df % 2:
        term, acc = c, 0.0
        if df > 1:
            acc = c
            for j in range(3, df - 1, 2):
                term *= c * c * (j - 1) / j
                acc += term
        inside = (2 / math.pi) * (theta + (s * acc if df > 1 else 0.0))
    else:
        term, acc = 1.0, 1.0
        for j in range(2, df - 1, 2):
            term *= c * c * (j - 1) / j
            acc += term
        inside = s * acc
    return (1 - inside) / 2


def t_quantile(p: float, df: int) -> float:
    if p < 0.5:
        return -t_quantile(1 - p, df)
    lo, hi = 0.0, 1.0
    while _t_tail(hi, df) > 1 - p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if _t_tail(mid, df) > 1 - p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2
