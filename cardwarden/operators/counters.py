"""Rates of sampled counters: growing numbers that start again from zero.

A rate looks back over a window from every step of a grid.  Inside it a counter's growth is the last
value minus the first plus what each reset threw away, stretched to the window's ends as far as the
samples' own spacing allows.  Each sample meets the steps that look back on it, a bounded number
(window / step), and windows are added up on the map side, so no window is ever collected; the sample
before, which a reset is known by, comes from blocks of time, so a series is never one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.functions.clock import epoch_micros, whole_units

SECOND = 1_000_000
BLOCK = 3600 * SECOND
# Fixed value: a window is filled to its end if the gap there is at most this many mean spacings.
FILL = 1.1


def with_previous(samples: DataFrame, series: list[str]) -> DataFrame:
    """Samples (series, at in microseconds, v) with the value before in the series as ``prior``.

    Samples of a series at one instant count once, with the greatest value; missing values are left out.
    """
    clean = samples.where(F.col("v").isNotNull() & ~F.isnan("v") & F.col("at").isNotNull())
    once = clean.groupBy(*series, "at").agg(F.max("v").alias("v")).withColumn("block", whole_units(F.col("at"), BLOCK))
    inside = Window.partitionBy(*series, "block").orderBy("at")
    # One row per series and block of time.
    last = once.groupBy(*series, "block").agg(F.max_by("v", "at").alias("last"))
    before = last.select(*series, "block", F.lag("last").over(Window.partitionBy(*series).orderBy("block")).alias("carried"))
    placed = once.withColumn("inside", F.lag("v").over(inside))
    same = [placed[c].eqNullSafe(before[c]) for c in [*series, "block"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = placed.join(before, on, "left")
    return joined.select(*[placed[c] for c in series], "at", "v", F.coalesce("inside", "carried").alias("prior"))


def counter_rates(samples: DataFrame, time: str, value: str, series: list[str], start, end,
                  step_seconds: int = 60, window_seconds: int = 60) -> DataFrame:
    """(step, series, increase, per_second) for every step of [start, end] with two samples or more.

    ``start`` and ``end`` are columns of the type of ``time``.  A window holds the samples after
    step - window up to the step itself.  Windows with one sample, or none, have no rate.
    """
    if step_seconds <= 0 or window_seconds <= 0:
        raise ValueError("step and window are positive")
    kind = samples.schema[time].dataType
    step, window = step_seconds * SECOND, window_seconds * SECOND
    origin, final = (epoch_micros(c, kind) for c in (start, end))
    rows = samples.select(*series, epoch_micros(F.col(time), kind).alias("at"), F.col(value).cast("double").alias("v"))
    known = with_previous(rows, series)
    # The steps s with s - window < at <= s: numbered from the grid's origin.
    first = F.greatest(F.ceil((F.col("at") - origin) / step), F.lit(0))
    last = F.least(F.ceil((F.col("at") + window - origin) / step) - 1, F.floor((final - origin) / step))
    spread = known.withColumn("nth", F.explode(F.when(first <= last, F.sequence(first, last))))
    reset = F.when(F.col("v") < F.col("prior"), F.col("prior")).otherwise(0.0)
    sums = spread.withColumn("reset", reset).groupBy(*series, "nth").agg(
        F.count("*").alias("n"), F.min("at").alias("t0"), F.max("at").alias("t1"), F.min_by("v", "at").alias("v0"),
        F.max_by("v", "at").alias("v1"), F.sum("reset").alias("resets"), F.min_by("reset", "at").alias("own"))
    at = (origin + F.col("nth") * step)
    return _extrapolated(sums.where("n > 1").withColumn("at", at), window).select(
        F.timestamp_micros(F.col("at")).cast(kind).alias("step"), *series, "increase",
        (F.col("increase") / window_seconds).alias("per_second"))


def _extrapolated(sums: DataFrame, window: int) -> DataFrame:
    """Growth between first and last sample, stretched towards both ends of the window.

    At an end whose gap is within ``FILL`` mean spacings the window is filled, else half a spacing is
    added.  At the start a counter is not taken back below zero.
    """
    # The first sample's own reset happened before it.
    grown = F.col("v1") - F.col("v0") + F.col("resets") - F.col("own")
    sampled = (F.col("t1") - F.col("t0")).cast("double")
    spacing = sampled / (F.col("n") - 1)
    head = (F.col("t0") - (F.col("at") - window)).cast("double")
    tail = (F.col("at") - F.col("t1")).cast("double")
    head = F.when(head >= spacing * FILL, spacing / 2).otherwise(head)
    zero = F.when((grown > 0) & (F.col("v0") >= 0), sampled * (F.col("v0") / grown))
    head = F.when(zero < head, zero).otherwise(head)
    tail = F.when(tail >= spacing * FILL, spacing / 2).otherwise(tail)
    return sums.withColumn("increase", grown * ((sampled + head + tail) / sampled))


def summed_rates(rates: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rates of all series added up by step and the given labels."""
    return rates.groupBy("step", *by).agg(F.sum("per_second").alias("per_second"))


def rate_ratio(rates: DataFrame, part: Column, by: list[str] = ()) -> DataFrame:
    """Per step the rate of the series that ``part`` picks over that of all; 0 where nothing grows."""
    sums = rates.groupBy("step", *by).agg(
        F.sum(F.when(part, F.col("per_second"))).alias("part"), F.sum("per_second").alias("whole"))
    return sums.select("step", *by, F.when(F.col("whole") > 0, F.coalesce("part", F.lit(0.0)) / F.col("whole")).otherwise(0.0).alias("ratio"))
