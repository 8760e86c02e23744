"""Exact arithmetic for money, counts and percentages.

Facts hold the numbers as they were read. Sums run over their decimal reading so that
they do not depend on the order in which partitions arrive; results are handed out as
DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What sums run over: eight decimals, and room for any amount.
EXACT = "decimal(38,8)"


def rounded(value: Column, digits: int = 2) -> Column:
    """Round half up on the decimal reading of a double."""
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def total(value: Column) -> Column:
    """Exact sum, as double."""
    return F.sum(value.cast(EXACT)).cast("double")


def safe_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded; NULL where the denominator is zero."""
    divisor = F.nullif(denominator.cast("double"), F.lit(0.0))
    return rounded(numerator.cast("double") / divisor, digits)


def mean(value: Column, digits: int = 2) -> Column:
    """Rounded average from an exact sum and a count."""
    return safe_ratio(total(value), F.count(value), digits)
