"""Arithmetic with the survey's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """``ROUND(part * 100 / whole, digits)`` in DOUBLE; NULL when whole is 0."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)


def safe_ratio_pct(part: Column, other: Column, digits: int = 0) -> Column:
    """``ROUND(part / (part + other) * 100, digits)``; NULL on a zero sum."""
    return F.round(F.try_divide(part.cast("double"), (part + other).cast("double")) * 100, digits)


def mean4(c: Column) -> Column:
    """Mean rounded to four places, the scale of an integer mean in the survey."""
    return F.round(F.avg(c), 4)
