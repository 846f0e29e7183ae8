"""Statistics as Column expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 26.2.17, error below 7.5e-8.
CDF_SCALE = 0.2316419
CDF_TERMS = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal for z >= 0, a polynomial; Spark has no erf."""
    t = 1 / (1 + F.lit(CDF_SCALE) * z)
    total = F.lit(0.0)
    for coefficient in reversed(CDF_TERMS):
        total = (total + F.lit(coefficient)) * t
    return F.exp(-z * z / 2) / F.sqrt(2 * F.pi()) * total


def two_sided_p(z: Column) -> Column:
    return 2 * upper_tail(F.abs(z))


def critical_z(confidence: float) -> float:
    """The two-sided critical value; a config scalar, computed once on the driver."""
    if not 0 < confidence < 1:
        raise ValueError("confidence lies between 0 and 1")
    return NormalDist().inv_cdf(0.5 + confidence / 2)


def chi_square_p(statistic: Column, df: int) -> Column:
    """The upper tail of the chi-square distribution, in its closed form for whole degrees of freedom."""
    half = statistic / 2
    if df % 2 == 0:
        term, total = F.lit(1.0), F.lit(1.0)
        for i in range(1, df // 2):
            term = term * half / i
            total = total + term
        return F.exp(-half) * total
    root = F.sqrt(statistic)
    tail, term = two_sided_p(root), root
    density = F.exp(-half) * math.sqrt(2 / math.pi)
    for i in range(1, (df - 1) // 2 + 1):
        tail = tail + density * term
        term = term * statistic / (2 * i + 1)
    return tail
