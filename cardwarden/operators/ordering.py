"""Exact order statistics and rankings without a single-task sort.

``percentile`` and ``median`` keep every distinct value in one task's buffer, and a window without
a partition sorts the table in one task.  Here a value of given rank is found by narrowing: count
rows in equal-width cells between the known minimum and maximum, keep the cell that holds the rank,
repeat inside it.  A pass is a scan with map-side aggregation into a bounded number of cells, so
neither hot values nor row counts make any task large, and nothing is sampled or approximated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 4096
LEAST_SPLITS = 512
ROWS_PER_SPLIT = 50_000
# Open intervals up to which a pass writes them into its one expression per row.
WIDE_INTERVALS = 32


@dataclass(frozen=True)
class Ranked:
    """The value at a zero-based rank and how many rows lie strictly below that value."""

    value: float
    below: int


def wide_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns as numbers, null where absent."""
    return df.select(*[
        F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in columns
    ])


def long_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(feature, value): one row per present number of the listed columns."""
    columns = list(columns)
    wide = wide_values(df, columns)
    if len(columns) == 1:
        one = wide.select(F.lit(columns[0]).alias("feature"), F.col(f"`{columns[0]}`").alias("value"))
        return one.where(F.col("value").isNotNull())
    long = wide.unpivot([], [f"`{c}`" for c in columns], "feature", "value")
    return long.where(F.col("value").isNotNull())


def extent(long: DataFrame) -> dict[str, tuple[int, float, float]]:
    """feature -> (rows, min, max); one row per feature reaches the driver."""
    rows = long.groupBy("feature").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    ).collect()
    return {r.feature: (r.n, r.lo, r.hi) for r in rows}


def wide_extent(wide: DataFrame) -> dict[str, tuple[int, float, float]]:
    """``extent`` of a table with a column per feature."""
    row = wide.agg(*[F.struct(F.count(c), F.min(c), F.max(c)).alias(str(i))
                     for i, c in enumerate(F.col(f"`{c}`") for c in wide.columns)]).first()
    return {c: tuple(one) for c, one in zip(wide.columns, row) if one[0]}


def order_statistics(
    long: DataFrame,
    ranks: dict[str, list[int]],
    bounds: dict[str, tuple[int, float, float]] | None = None,
    cells: int = CELLS,
) -> dict[tuple[str, int], Ranked]:
    """The values at the given zero-based ranks of each feature's ascending order."""
    return _located(ranks, bounds or extent(long), lambda pending: _narrow(long, pending, cells))


def _located(
    ranks: dict[str, list[int]],
    bounds: dict[str, tuple[int, float, float]],
    narrow: Callable[[dict], dict],
) -> dict[tuple[str, int], Ranked]:
    found: dict[tuple[str, int], Ranked] = {}
    # open interval -> ranks still looked for inside it
    pending: dict[tuple[str, float, float, int], list[int]] = {}
    for feature, wanted in ranks.items():
        n, lo, hi = bounds[feature]
        if math.isinf(lo) or math.isinf(hi):
            raise ValueError(f"{feature} holds infinite values")
        for rank in wanted:
            if not 0 <= rank < n:
                raise ValueError(f"rank {rank} outside {n} rows of {feature}")
        pending[(feature, lo, hi, 0)] = sorted(set(wanted))

    while True:
        for key in [k for k in pending if k[1] == k[2]]:
            feature, lo, _, below = key
            for rank in pending.pop(key):
                found[(feature, rank)] = Ranked(lo, below)
        if not pending:
            return found
        narrowed = narrow(pending)
        if set(narrowed) & set(pending):
            raise ValueError("values too far apart to narrow in double precision")
        pending = narrowed


def _open_intervals(spark: SparkSession, pending: dict) -> DataFrame:
    frame = spark.createDataFrame(
        [(i, f, lo, hi, below, ranks) for i, ((f, lo, hi, below), ranks) in enumerate(pending.items())],
        "interval int, feature string, lo double, hi double, below bigint, ranks array<bigint>",
    )
    # Bounded: one row per open interval, at most features x ranks of them.
    return F.broadcast(frame)


def _narrow(long: DataFrame, pending: dict, cells: int) -> dict:
    table = _open_intervals(long.sparkSession, pending)
    inside = long.join(table.drop("below", "ranks"), "feature").where(
        F.col("value").between(F.col("lo"), F.col("hi"))
    )
    return _holding(inside.withColumn("cell", _cell("value", F.col("lo"), F.col("hi"), cells)), table)


def _narrow_wide(wide: DataFrame, pending: dict, cells: int) -> dict:
    """``_narrow`` over a column per feature: rows outside all open intervals leave before anything is counted."""
    open_ = [F.col(f"`{f}`").between(lo, hi) for f, lo, hi, _ in pending]
    spots = [F.struct(F.when(held, i).alias("interval"), F.when(held, _cell(f, F.lit(lo), F.lit(hi), cells)).alias("cell"),
                      F.col(f"`{f}`").alias("value")) for i, (held, (f, lo, hi, _)) in enumerate(zip(open_, pending))]
    inside = wide.where(reduce(Column.__or__, open_)).select(F.inline(F.array(*spots))).where("interval is not null")
    return _holding(inside, _open_intervals(wide.sparkSession, pending))


def _cell(value: str, lo: Column, hi: Column, cells: int) -> Column:
    step = (F.col(f"`{value}`") - lo) / (hi - lo) * F.lit(float(cells))
    return F.least(step.cast("int"), F.lit(cells - 1))


def _holding(inside: DataFrame, table: DataFrame) -> dict:
    """The cells of (interval, cell, value) that hold a wanted rank, as the next open intervals."""
    counted = inside.groupBy("interval", "cell").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    up_to = Window.partitionBy("interval").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (
        counted.withColumn("through", F.sum("n").over(up_to))
        .join(table.select("interval", "feature", "below", "ranks"), "interval")
        .withColumn("start", F.col("below") + F.col("through") - F.col("n"))
        .withColumn("ranks", F.filter(
            "ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n"))))
        .where(F.size("ranks") > 0)
    )
    return {
        (r.feature, r.lo, r.hi, r.start): list(r.ranks)
        for r in placed.select("feature", "lo", "hi", "start", "ranks").collect()
    }


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float],
    bounds: dict[str, tuple[int, float, float]] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, nulls and NaN left out; all-null columns give None."""
    if len(columns) * 2 * len(probs) <= WIDE_INTERVALS and len(set(columns)) == len(columns):
        rows, extent_of, narrowed = wide_values(df, columns), wide_extent, _narrow_wide
    else:
        rows, extent_of, narrowed = long_values(df, columns), extent, _narrow
    bounds = extent_of(rows) if bounds is None else bounds
    spots = {
        c: [(n - 1) * p for p in probs] for c, (n, _, _) in bounds.items()
    }
    ranks = {c: [r for s in at for r in {math.floor(s), math.ceil(s)}] for c, at in spots.items()}
    hits = _located(ranks, bounds, lambda pending: narrowed(rows, pending, CELLS))
    out: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in spots:
            out[c] = [None] * len(probs)
            continue
        out[c] = []
        for s in spots[c]:
            low = hits[(c, math.floor(s))].value
            high = hits[(c, math.ceil(s))].value
            out[c].append(low + (high - low) * (s - math.floor(s)))
    return out


def grid_of(n: int) -> list[float]:
    """Evenly spaced probabilities: as many as buckets for n rows, however many those are."""
    wanted = max(LEAST_SPLITS, n // ROWS_PER_SPLIT)
    return [i / wanted for i in range(1, wanted)]


def balanced_splits(n: int, grid: list[float] | None) -> list[float]:
    """Inner bucket bounds from an approximate grid: enough of them for the row count, each once.

    The grid only balances the buckets; results do not depend on it.
    """
    wanted = n // ROWS_PER_SPLIT
    if not grid or wanted < 2:
        return []
    stride = max(1, len(grid) // wanted)
    return sorted(set(grid[::stride]))


def bucketed(df: DataFrame, column: str, splits: list[float], output: str = "cell") -> DataFrame:
    """Monotone bucket number of a non-null double by binary search over the bounds."""
    if not splits:
        return df.withColumn(output, F.lit(0))
    found = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=column, outputCol=output
    ).transform(df)
    return found.withColumn(output, F.col(output).cast("int"))


def text_bounds(values: DataFrame, column: str, n: int = 128) -> list[str]:
    """Bucket bounds for text: n distinct values picked by their digest, then sorted."""
    picked = values.orderBy(F.md5(F.col(column)), column).limit(n).collect()
    return sorted({r[column] for r in picked})


def dense_codes(values: DataFrame, column: str, code: str = "code", spread: int = 128) -> DataFrame:
    """0-based rank of each distinct text value in ascending order.

    Values go into ranges around bounds picked among themselves; a value's code is the size of the
    ranges before it plus its place inside its own.  No task sorts more than one range.
    """
    bounds = text_bounds(values, column, spread)
    edges = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<string>")
    placed = values.select(
        column, F.size(F.filter(edges, lambda b: b <= F.col(column))).alias("__range"))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    # At most spread + 1 rows.
    before = sizes.select(
        "__range",
        F.coalesce(
            F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__before"),
    )
    here = F.row_number().over(Window.partitionBy("__range").orderBy(column)) - 1
    return (
        placed.join(F.broadcast(before), "__range")
        .select(column, (F.col("__before") + here).alias(code))
    )


def first_by(df: DataFrame, key: str | list[str], order: list[Column], latest: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by the order columns.

    A struct min/max aggregates on the map side, so a key with a third of all rows sends one row
    per task; a window would send them all to one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    if not any(isinstance(df.schema[c].dataType, T.MapType) for c in rest):
        place = F.struct(place.alias("p"), row.alias("r"))  # equal places: the smaller row, always
    pick = F.max_by(row, place) if latest else F.min_by(row, place)
    best = df.groupBy(*keys).agg(pick.alias("__row"))
    return best.select(*[F.col(k) if k in keys else F.col(f"__row.`{k}`").alias(k) for k in df.columns])
