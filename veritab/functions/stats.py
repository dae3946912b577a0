"""Small statistical helpers evaluated on aggregated (tiny) rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _survival_function():
    """The survival function as one closure: a task that runs it needs this package neither installed nor on its path."""
    import math

    def gammaincc(a: float, x: float) -> float:
        """Regularized upper incomplete gamma Q(a, x) (series / continued fraction)."""
        if x <= 0:
            return 1.0
        if a <= 0:
            return 0.0
        lg = math.lgamma(a)
        if x < a + 1.0:
            term = total = 1.0 / a
            ap = a
            for _ in range(10000):
                ap += 1.0
                term *= x / ap
                total += term
                if abs(term) < abs(total) * 1e-16:
                    break
            return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - lg))
        tiny = 1e-300
        b = x + 1.0 - a
        c = 1.0 / tiny
        d = 1.0 / b
        h = d
        for i in range(1, 10000):
            an = -i * (i - a)
            b += 2.0
            d = an * d + b
            d = tiny if abs(d) < tiny else d
            c = b + an / c
            c = tiny if abs(c) < tiny else c
            d = 1.0 / d
            delta = d * c
            h *= delta
            if abs(delta - 1.0) < 1e-16:
                break
        return h * math.exp(-x + a * math.log(x) - lg)

    def survival(stat, dof) -> float:
        if stat is None or dof is None or dof <= 0 or (isinstance(stat, float) and math.isnan(stat)):
            return float("nan")
        return gammaincc(dof / 2.0, stat / 2.0)

    return survival


def chi2_survival(stat: float, dof: int) -> float:
    """P(X >= stat) for a χ² variable with ``dof`` degrees of freedom."""
    return _survival_function()(stat, dof)


def chi2_sf(stat: Column, dof: Column) -> Column:
    """:func:`chi2_survival` as a column; runs on one aggregated row."""
    survival = _survival_function()

    def tail(stat, dof):
        return [survival(float(s), int(d)) if s == s and d == d and s is not None and d is not None else float("nan") for s, d in zip(stat, dof)]

    def run(stat: pd.Series, dof: pd.Series) -> pd.Series:
        return type(stat)(tail(stat, dof), dtype="float64")

    return F.pandas_udf(run, DoubleType())(stat, dof)


def sample_skewness(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness G1 from the population value g1 (NULL when n < 3)."""
    n = n.cast("double")
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_excess_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from the population excess g2 (NULL when n < 4)."""
    n = n.cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
