"""Tail probabilities of the two-sample Kolmogorov-Smirnov statistic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TERMS = 100


def series_p(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: the Kolmogorov series at the effective sample size, as a plain expression.

    The argument carries the usual finite-sample shift ``z + 1/(6*sqrt(e)) + (z-1)/(4*e)``, ``e = round(n*m/(n+m))``, so
    that the series follows the one-sample distribution at the effective size.
    """
    size = F.bround(n.cast("double") * m / (n + m), 0)
    z = F.sqrt(size) * statistic
    x = z + 1.0 / (6.0 * F.sqrt(size)) + (z - 1.0) / (4.0 * size)

    def term(k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return sign * F.exp(-2.0 * k * k * x * x)

    terms = F.transform(F.sequence(F.lit(1), F.lit(_TERMS)), term)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, value: acc + value)
    probability = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * total))
    return F.when(statistic <= 0, F.lit(1.0)).when(x < 0.2, F.lit(1.0)).otherwise(probability)


def _equal_sizes(n: int, step: int) -> float:
    """P(n*D >= step) for two samples of size n: alternating sum of binomial ratios."""
    log_all = math.lgamma(2 * n + 1) - 2 * math.lgamma(n + 1)
    total = 0.0
    for k in range(n // step, 0, -1):
        away = k * step
        log_paths = math.lgamma(2 * n + 1) - math.lgamma(n - away + 1) - math.lgamma(n + away + 1)
        total = math.exp(log_paths - log_all) - total
    return 2.0 * total


def _lattice(n: int, m: int, bound: int) -> float:
    """P(max|i*m - j*n| >= bound) over uniform lattice paths from (0,0) to (n,m).

    Walks along i + j and moves probability mass forward, over the cells inside the bound only: about
    2 * bound / (n + m) of them at a time. Mass that steps out is counted and gone.
    """
    low, mass, outside = 0, np.ones(1), 0.0
    for taken in range(n + m):
        i = np.arange(low, low + len(mass))
        left = n + m - taken
        moved = np.zeros(len(mass) + 1)
        moved[:-1] = mass * (m - taken + i) / left
        moved[1:] += mass * (n - i) / left
        # i * (n + m) must lie strictly within bound of (taken + 1) * n.
        middle = (taken + 1) * n
        first = max(low, (middle - bound) // (n + m) + 1)
        last = min(low + len(mass), -((-middle - bound) // (n + m)) - 1)
        if last < first:
            return 1.0
        outside += float(moved[: first - low].sum() + moved[last - low + 1 :].sum())
        low, mass = first, moved[first - low : last - low + 1]
    return outside


def exact_tail(n: int, m: int, bound: int) -> float:
    """Exact P(D >= bound/(n*m)) for sample sizes n and m."""
    if bound <= 0:
        return 1.0
    probability = _equal_sizes(n, max(1, round(bound / n))) if n == m else _lattice(n, m, bound)
    return min(1.0, max(0.0, probability))


@F.pandas_udf(T.DoubleType())
def exact_p(n: pd.Series, m: pd.Series, bound: pd.Series) -> pd.Series:
    """Exact two-sided p-value; one short row per compared dimension, no sample data. NULL sizes give NULL."""
    rows = zip(n, m, bound)
    return pd.Series([exact_tail(int(a), int(b), int(c)) if pd.notna(a) else None for a, b, c in rows], dtype="float64")
