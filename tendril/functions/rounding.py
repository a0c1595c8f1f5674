"""Exact decimal rates and ratios: HALF_UP for features, half-even for profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY, RATE, RATIO = "decimal(18,2)", "decimal(10,4)", "decimal(18,6)"


def ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """numerator / denominator, HALF_UP; null where the denominator is zero or either is null."""
    return F.round(numerator / F.nullif(denominator, F.lit(0).cast("decimal(1,0)")), digits).cast(f"decimal({12 + digits},{digits})")


def count_ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    return ratio(numerator.cast("decimal(18,0)"), denominator.cast("decimal(18,0)"), digits)


def rate(count: Column, total: Column) -> Column:
    """count / total to four places, HALF_UP; 0.0000 for an empty total."""
    return F.when(total > 0, count_ratio(count, total, 4)).otherwise(F.lit(0)).cast(RATE)


def profile_rate(count: Column, total: Column) -> Column:
    """count / total as a double to four places, half-even in decimal digits; 0.0 for an empty total."""
    return F.when(total > 0, F.bround(count / F.nullif(total, F.lit(0)), 4)).otherwise(F.lit(0.0))
