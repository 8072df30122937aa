"""Aggregate expressions with the null and constant-input rules of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are there; null if either is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    n = F.count(a)
    varies = (n > 1) & (F.max(a) > F.min(a)) & (F.max(b) > F.min(b))
    cov = F.when(varies, F.covar_pop(a, b))
    return cov / F.when(varies, F.stddev_pop(a) * F.stddev_pop(b))


def average_rank(df: DataFrame, keys: list[str], value: str, out: str, descending: bool = False) -> DataFrame:
    """Rank from 1 within keys, ties sharing the mean of their places."""
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranks = F.rank().over(Window.partitionBy(*keys).orderBy(order))
    ties = F.count("*").over(Window.partitionBy(*keys, value))
    return df.withColumn(out, ranks + (ties - 1) / F.lit(2.0))


def weighted_mean(value: Column, weight: Column) -> Column:
    total = F.sum(F.when(value.isNotNull(), weight))
    return F.sum(value * weight) / F.when(total != 0, total)


def skewness_pop(c: str) -> Column:
    return F.when(F.stddev_pop(c) > 0, F.skewness(c))


def kurtosis_excess(c: str) -> Column:
    return F.when(F.stddev_pop(c) > 0, F.kurtosis(c))
