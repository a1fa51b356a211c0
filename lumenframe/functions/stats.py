"""Statistics over groups and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The value, or null if it is null, not a number or infinite."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), c)


def summary(c: Column, prefix: str) -> list[Column]:
    """Mean, population deviation, least, greatest and count of the finite values."""
    x = finite(c)
    made = {"mean": F.avg(x), "std": F.stddev_pop(x), "min": F.min(x), "max": F.max(x)}
    return [*(F.round(v, 6).alias(f"{prefix}__{k}") for k, v in made.items()), F.count(x).alias(f"{prefix}__count")]


def entropy(p: Column, eps: float = 1e-9) -> Column:
    """Sum of -p ln(p + eps) over the rows of a group."""
    return F.sum(-p * F.log(p + eps))


def gini(value: Column, rank: Column, n: Column) -> Column:
    """Gini of a group's values, given each one's rank in ascending order and the count."""
    return F.when(F.sum(value) > 0, F.sum((2 * rank - n - 1) * value) / (F.max(n) * F.sum(value))).otherwise(F.lit(0.0))


def bin_of(value: Column, lo: Column, hi: Column, bins: Column | int) -> Column:
    """The equal-width bin of a value, from 0; the last one is closed, and all equal values share the middle one."""
    n = F.lit(bins) if isinstance(bins, int) else bins
    return F.when(hi > lo, F.least(n - 1, F.floor((value - lo) / ((hi - lo) / n)))).otherwise(F.floor(n / 2)).cast("int")


def bin_counts(bin_: Column, bins: int) -> Column:
    """Rows in each bin, as an array, of a group."""
    return F.array(*(F.count_if(bin_ == i) for i in range(bins)))


def counts_entropy(counts: Column, eps: float = 1e-9) -> Column:
    """Entropy of the shares of counts, each raised by ``eps``."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c + eps)
    return F.aggregate(counts, F.lit(0.0), lambda a, c: a - (c + eps) / total * F.log((c + eps) / total))
