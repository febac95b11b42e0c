"""Small numeric helpers that run inside tasks."""

from __future__ import annotations

import math

import numpy as np


def weighted_inversions(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> float:
    """Weight of pairs with first[i] < first[j] and second[i] > second[j].

    Rows are split by one bit of `second` at a time, highest first; at each bit, a zero counts the
    ones before it among the rows that agree on all higher bits.
    """
    order = np.lexsort((second, first))
    codes = np.unique(second[order], return_inverse=True)[1]
    weight = weight[order].astype("float64")
    total = 0.0
    for shift in range(int(codes.max()).bit_length() - 1, -1, -1):
        bit = (codes >> shift) & 1
        ones = weight * bit
        before = np.cumsum(ones) - ones
        group = codes >> (shift + 1)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        base = np.repeat(before[starts], np.diff(np.r_[starts, len(codes)]))
        total += float(np.sum(weight * (1 - bit) * (before - base)))
        step = np.argsort(codes >> shift, kind="stable")
        codes, weight = codes[step], weight[step]
    return total


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method; an error if it does not settle."""
    tiny = 1e-300

    def away_from_zero(v: float) -> float:
        return v if abs(v) > tiny else tiny

    c, d = 1.0, 1.0 / away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    value = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / away_from_zero(1.0 + step * d)
            c = away_from_zero(1.0 + step / c)
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"no p-value for a={a}, b={b}, x={x}")


def two_sided_p(r: float, n: float) -> float | None:
    """Two-sided p-value of a correlation r over n pairs; undefined up to two pairs."""
    if r is None or n is None or n <= 2 or math.isnan(r):
        return None
    a, b = (n - 2) / 2.0, 0.5
    x = 1.0 - min(1.0, r * r)
    if x <= 0.0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) if x < 1.0 else 0.0
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
