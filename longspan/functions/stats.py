"""Aggregate expressions with null, constant-column and small-sample rules spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_std(c: Column) -> Column:
    """Sample standard deviation, 0 for one value, null for none."""
    return F.when(F.count(c) == 1, F.lit(0.0)).otherwise(F.stddev_samp(c))


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted skewness: null below three values, 0 for a constant."""
    n = F.count(c).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(F.count(c) >= 3, F.when(F.min(c) == F.max(c), F.lit(0.0)).otherwise(F.skewness(c) * factor))


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation of rows complete in both; null (not an error) when either side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
