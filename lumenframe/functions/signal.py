"""Filters along an ordered window, as expressions of neighbouring rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def neighbours(c: str, w: WindowSpec, radius: int, edge: str = "nearest") -> list[Column]:
    """The values from ``radius`` rows before to ``radius`` after; beyond the ends the end value, or 0."""
    ends = (F.lit(0.0), F.lit(0.0)) if edge == "zero" else (F.first(c).over(w.rowsBetween(-(2**63), 2**63 - 1)), F.last(c).over(w.rowsBetween(-(2**63), 2**63 - 1)))
    before = [F.when(F.row_number().over(w) > k, F.lag(c, k).over(w)).otherwise(ends[0]) for k in range(radius, 0, -1)]
    rows = F.count(F.lit(1)).over(w.rowsBetween(-(2**63), 2**63 - 1))
    after = [F.when(F.row_number().over(w) + k <= rows, F.lead(c, k).over(w)).otherwise(ends[1]) for k in range(1, radius + 1)]
    return [*before, F.col(c), *after]


def kernel(sigma: float) -> list[float]:
    """Weights of a Gaussian out to four deviations, summing to 1."""
    radius = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


def gaussian(c: str, w: WindowSpec, sigma: float) -> Column:
    """Gaussian smoothing, the end values carried on beyond the ends."""
    weights = kernel(sigma)
    total = F.lit(0.0)
    for weight, x in zip(weights, neighbours(c, w, len(weights) // 2), strict=True):
        total = total + x * weight
    return total


def median_filter(c: str, w: WindowSpec, size: int = 5) -> Column:
    """Median of ``size`` neighbours, zeros beyond the ends."""
    return F.element_at(F.array_sort(F.array(*neighbours(c, w, size // 2, "zero"))), size // 2 + 1)


def local_fit(window: int, degree: int, at: int) -> list[float]:
    """Weights of ``window`` values in a row that give their least-squares polynomial at place ``at``."""
    places = np.vander(np.arange(window) - at, degree + 1, increasing=True)
    return np.linalg.pinv(places)[0].tolist()


def savitzky_golay(c: str, w: WindowSpec, window: int, degree: int) -> Column:
    """Each value replaced by the polynomial of ``degree`` through the ``window`` values (an odd number) around it, fitted by least
    squares; near an end, by that of the first or last ``window`` values. A key of ``window`` rows or fewer keeps its values."""
    half, whole = window // 2, w.rowsBetween(-(2**63), 2**63 - 1)
    n, k = F.count(F.lit(1)).over(whole), F.row_number().over(w)

    def fitted(at: int) -> Column:
        parts = [(F.lag(c, at - i).over(w) if i < at else F.lead(c, i - at).over(w) if i > at else F.col(c)) * x for i, x in enumerate(local_fit(window, degree, at))]
        return sum(parts[1:], parts[0])

    out = F.when(n <= window, F.col(c).cast("double"))
    for at in range(half):
        out = out.when(k == at + 1, fitted(at)).when(n - k == at, fitted(window - 1 - at))
    return out.otherwise(fitted(half))
