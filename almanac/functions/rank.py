"""Ordinal scales of confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_confidence(c: Column) -> Column:
    """low 1, medium 2, high 3, anything else 0."""
    return F.when(c == "low", 1).when(c == "medium", 2).when(c == "high", 3).otherwise(0)


def source_confidence(c: Column) -> Column:
    """low 0, medium 1, high 2, anything else -1."""
    return F.when(c == "low", 0).when(c == "medium", 1).when(c == "high", 2).otherwise(-1)


def clamp(c: Column, low: int, high: int) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))
