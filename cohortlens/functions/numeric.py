"""Lenient casts, guarded arithmetic and small aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def try_to_int(c: Column) -> Column:
    """Whole number from text; fractions round half up, anything unreadable is null.

    A plain ``try_cast('12.7' as int)`` gives null in Spark, and published service counts do
    carry fractions. Reading the text as a decimal without digits rounds it. It is also much faster:
    a failed cast of text to an integer type costs an exception per row.
    """
    return c.try_cast(T.DecimalType(38, 0)).try_cast("bigint")


def try_to_dec(c: Column, precision: int, scale: int) -> Column:
    """Fixed-point number from text; null when unreadable or out of range."""
    return c.try_cast(T.DecimalType(precision, scale))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null unless the denominator is positive.

    Both sides are converted first: dividing two wide decimals would cut the quotient's scale.
    """
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def weighted_total(average: Column, n: Column) -> Column:
    """Total rebuilt from a per-unit average and a unit count."""
    return F.sum(average * n)


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; null counts as not holding."""
    return F.count_if(condition)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; null for an empty whole."""
    exact = F.when(whole > 0, F.lit(100.0) * part / whole)
    return F.round(exact, digits)
