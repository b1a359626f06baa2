"""Guarded arithmetic columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_at(c: Column, low: float) -> Column:
    """Values below ``low`` become ``low``; null stays null."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def cap_at(c: Column, high: float) -> Column:
    """Values above ``high`` become ``high``; null stays null."""
    return F.when(c.isNotNull(), F.least(c, F.lit(high)))


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / max(den, 1) where den > 0, otherwise 0."""
    return F.when(den > 0, num / F.greatest(den, F.lit(1))).otherwise(F.lit(0.0))


def per_thousand(num: Column, den: Column) -> Column:
    return num / den * 1000


def mean_of(*cols: Column) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / float(len(cols))


def half_even(c: Column, digits: int) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(c, digits)
