"""Decisions and directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden import fixed


def flagged(probability: Column, threshold: float = fixed.THRESHOLD) -> Column:
    """The bound itself counts as flagged."""
    return probability >= F.lit(threshold)


def decision(probability: Column, threshold: float = fixed.THRESHOLD) -> Column:
    return F.when(flagged(probability, threshold), fixed.REVIEW).otherwise(fixed.LEGITIMATE)


def direction(attribution: Column) -> Column:
    """Zero does not push toward fraud."""
    return F.when(attribution > 0, fixed.TOWARD_FRAUD).otherwise(fixed.TOWARD_LEGITIMATE)
