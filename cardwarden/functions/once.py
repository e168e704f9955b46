"""Keeping an expensive expression in one place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """The value as the only row of a generator.

    Filters are not pushed below a generator, where a condition on fields of the value would repeat
    its computation per field, nor are they rewritten there in terms of every column it mentions,
    which takes the optimiser exponential time for a check over many columns.
    """
    return F.explode(F.array(value))
