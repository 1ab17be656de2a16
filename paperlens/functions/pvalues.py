"""P-values of drift statistics, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of a published Chebyshev fit of erfc, relative error below 1.2e-7.
ERFC_FIT = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
    -0.82215223, 0.17087277,
]
SERIES_TERMS = 100


def erfc(x: Column) -> Column:
    """Complementary error function of x >= 0."""
    t = 1 / (1 + x / 2)
    fit = F.lit(ERFC_FIT[-1])
    for coefficient in reversed(ERFC_FIT[:-1]):
        fit = fit * t + coefficient
    return t * F.exp(fit - x * x)


def z_p_value(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic."""
    return F.when(z == 0, F.lit(1.0)).otherwise(erfc(F.abs(z) / math.sqrt(2)))


def chi2_p_value(x: Column, dof: Column) -> Column:
    """Upper tail for 2, 3 or 4 degrees of freedom, in closed form."""
    half = x / 2
    return (
        F.when(x == float("inf"), F.lit(0.0))
        .when(dof == 2, F.exp(-half))
        .when(dof == 3, erfc(F.sqrt(half)) + F.sqrt(4 * half / math.pi) * F.exp(-half))
        .when(dof == 4, F.exp(-half) * (1 + half))
    )


def ks_p_value(d: Column, m: Column, n: Column) -> Column:
    """Upper tail of the two-sample statistic by the asymptotic series, at every size. NULL for an empty side."""
    x = d * F.sqrt(m / (m + n) * n)

    def add(total: Column, k: Column) -> Column:
        return total + F.when(k % 2 == 1, 1).otherwise(-1) * F.exp(-2 * k * k * x * x)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), add)
    tail = F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2 * total, F.lit(0.0)), F.lit(1.0)))
    return F.when((m > 0) & (n > 0) & d.isNotNull(), tail)
