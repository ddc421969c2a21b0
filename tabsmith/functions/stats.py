"""Aggregate expressions with pandas' conventions.

All are plain built-in aggregates combined with arithmetic, so they stay inside
whole-stage codegen and aggregate partially on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corrected_skewness(c: Column) -> Column:
    """Bias-corrected sample skewness G1.

    ``G1 = sqrt(n(n-1)) / (n-2) * g1`` with ``g1`` Spark's population skewness.
    Undefined (null) for n < 3; zero variance gives 0 like pandas.
    """
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.var_pop(c) == 0, F.lit(0.0))
        .otherwise(F.sqrt(n * (n - 1)) / (n - 2) * g1)
    )


def corrected_kurtosis(c: Column) -> Column:
    """Bias-corrected sample excess kurtosis G2.

    ``G2 = (n-1) / ((n-2)(n-3)) * ((n+1) g2 + 6)`` with ``g2`` Spark's population
    excess kurtosis. Undefined for n < 4; zero variance gives 0.
    """
    n = F.count(c).cast("double")
    g2 = F.kurtosis(c)
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(F.var_pop(c) == 0, F.lit(0.0))
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def pairwise_pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over pairwise-complete rows; constant input gives null.

    ``corr()`` raises DIVIDE_BY_ZERO under ANSI on a constant column, so the
    covariance is divided by the two population deviations with ``try_divide``.
    """
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x)
    ys = F.when(both, y)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.when(den > 0, F.try_divide(F.covar_pop(xs, ys), den))
