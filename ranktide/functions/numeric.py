"""Arithmetic shared by the views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a non-negative double half up by floor, the same on every engine."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio_or_zero(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """``part * factor / whole`` as a double, 0 when ``whole`` is not positive or is NULL."""
    return F.when(whole > 0, part * F.lit(factor) / whole).otherwise(F.lit(0.0))


def zero_as_null(value: Column) -> Column:
    """Position 0 means "not ranking" and takes no part in averages."""
    return F.when(value != 0, value)
