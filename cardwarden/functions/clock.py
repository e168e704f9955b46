"""Times as whole numbers, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000


def epoch_micros(time: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970 of a timestamp.

    One without a time zone is read as UTC, field by field: casting it to an instant would go
    through the session's time zone.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(time)
    if not isinstance(dtype, T.TimestampNTZType):
        raise TypeError(f"not a timestamp: {dtype.simpleString()}")
    minutes = (F.unix_date(F.to_date(time)).cast("bigint") * 24 + F.hour(time)) * 60 + F.minute(time)
    return minutes * (60 * SECOND) + (F.extract(F.lit("SECOND"), time) * SECOND).cast("bigint")


def whole_units(micros: Column, unit: int) -> Column:
    """Whole units, rounded down, without passing through a double."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(unit)), F.lit(unit))
