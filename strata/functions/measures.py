"""Numeric comparisons used when layers are checked against each other."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gap(left: Column, right: Column, scale: int | None = None) -> Column:
    """Absolute difference, NULL when either side is missing."""
    distance = F.abs(left - right)
    return distance if scale is None else F.round(distance, scale)


def gap_or_zero(left: Column, right: Column) -> Column:
    """Absolute difference where two missing values agree (0) and one missing value is NULL."""
    return F.when(left.isNull() & right.isNull(), F.lit(0)).otherwise(gap(left, right))
