"""The normal distribution, which Spark SQL lacks, as column arithmetic."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, functions as F

_SERIES_UPTO = 2.0
_TERMS = 60
"""Enough for 1e-13 on both sides of ``_SERIES_UPTO``: terms shrink fastest far from it."""


def _erf_by_series(x: Column) -> Column:
    """2/sqrt(pi) exp(-x^2) times the sum of 2^n x^(2n+1) / (1 * 3 * … * (2n+1)): no term is negative, none cancel."""
    first = F.struct(x.alias("term"), x.alias("total"))

    def add(so_far: Column, n: Column) -> Column:
        term = so_far["term"] * 2.0 * x * x / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (so_far["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), first, add, lambda s: s["total"])
    return F.lit(2 / math.sqrt(math.pi)) * F.exp(-x * x) * total


def _erfc_by_fraction(x: Column) -> Column:
    """exp(-x^2)/sqrt(pi) over the continued fraction x + (1/2)/(x + (2/2)/(x + (3/2)/(x + …))), from its end."""
    below = F.aggregate(F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1)), x, lambda rest, k: x + k / 2.0 / rest)
    return F.exp(-x * x) / math.sqrt(math.pi) / below


def erfc(x: Column) -> Column:
    """Complementary error function of ``x >= 0``."""
    return F.when(x < _SERIES_UPTO, 1.0 - _erf_by_series(x)).otherwise(_erfc_by_fraction(x))


def two_sided_p(z: Column) -> Column:
    """P(|Z| > |z|); null for null and for NaN."""
    return F.when(~F.isnan(z), erfc(F.abs(z.cast("double")) / math.sqrt(2)))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)
