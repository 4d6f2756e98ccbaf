"""Outlier scores and three-valued flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; null without spread."""
    return F.when(stddev > 0, (value - mean) / stddev)


def modified_zscore(value: Column, median: Column, mad: Column, constant: float = 0.6745) -> Column:
    """Distance from the median in scaled median absolute deviations; null without spread."""
    return F.when(mad > 0, F.lit(constant) * (value - median) / mad)


def is_outlier(score: Column, threshold: float) -> Column:
    """The threshold itself already counts as an outlier; a null score gives a null flag."""
    return F.abs(score) >= F.lit(threshold)


def gated_flag(score: Column, threshold: float, coverage: Column, floor: int) -> Column:
    """Outlier flag that thin coverage turns to false, even when the score is null."""
    return is_outlier(score, threshold) & (coverage >= F.lit(floor))


def any_of(flags: list[Column]) -> Column:
    """True if any flag is true; never null."""
    return reduce(Column.__or__, [F.coalesce(f, F.lit(False)) for f in flags])
