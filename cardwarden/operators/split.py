"""Chronological split at exact row positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions.clock import epoch_micros
from cardwarden.functions.numeric import percent

PARTS = ["train", "valid", "test"]


# Rows without a time, and among equal times those without an id, sort last.
LAST = 2 ** 63 - 1
CELLS = 4096


def _clock(df: DataFrame, time: str) -> Column:
    """The time as a whole number: microseconds for timestamps."""
    if isinstance(df.schema[time].dataType, (T.TimestampType, T.TimestampNTZType)):
        value = epoch_micros(F.col(time), df.schema[time].dataType)
    else:
        value = F.col(time).cast("bigint")
    return F.coalesce(value, F.lit(LAST))


def _ident(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint"), F.lit(LAST))


def whole_at_ranks(rows: DataFrame, value: str, ranks: list[int], ends: tuple[int, int] | None = None) -> dict[int, tuple[int, int]]:
    """rank -> (the value at that 0-based position in ascending order, rows with smaller values).

    Whole numbers all the way, so ids beyond 2^53 keep their places.  Rows are counted in at most
    CELLS cells per open interval, with map-side aggregation, until the cell of a rank is one value.
    Open intervals are equal or apart, so one pass serves all ranks.
    """
    lo, hi = ends or rows.agg(F.min(value), F.max(value)).first()
    found: dict[int, tuple[int, int]] = {}
    open_ = {r: (lo, hi, 0) for r in ranks}  # rank -> lowest, highest, rows below the lowest
    while open_:
        label: Column = F.lit(None).cast("int")
        cell: Column = F.lit(None).cast("bigint")
        spans = sorted({(lo, hi) for lo, hi, _ in open_.values()})
        widths = [(hi - lo) // CELLS + 1 for lo, hi in spans]
        for n, ((lo, hi), width) in enumerate(zip(spans, widths)):
            inside = F.col(value).between(lo, hi)
            # Differences of far-apart numbers do not fit a bigint.
            kind = "bigint" if hi - lo < 2 ** 63 else "decimal(20,0)"
            place = F.call_function("div", F.col(value).cast(kind) - F.lit(lo).cast(kind), F.lit(width).cast(kind))
            label, cell = F.when(inside, n).otherwise(label), F.when(inside, place).otherwise(cell)
        counts: dict[int, list[tuple[int, int]]] = {}
        # At most CELLS rows per open interval.
        for r in rows.select(label.alias("span"), cell.alias("cell")).where("span is not null").groupBy(
                "span", "cell").count().collect():
            counts.setdefault(r["span"], []).append((r["cell"], r["count"]))
        still = {}
        for rank, (lo, hi, below) in open_.items():
            n = spans.index((lo, hi))
            for at, many in sorted(counts[n]):
                if rank < below + many:
                    low = lo + at * widths[n]
                    if widths[n] == 1:
                        found[rank] = (low, below)
                    else:
                        still[rank] = (low, min(hi, low + widths[n] - 1), below)
                    break
                below += many
        open_ = still
    return found


def cut_points(df: DataFrame, time: str, key: str,
               ends: tuple[float, ...] = (fixed.TRAIN_END, fixed.VALID_END)) -> list[tuple[int, int] | None]:
    """(time, key) of the first row of every later part; ``None`` when a part is empty.

    Positions are ``int(n * end)`` in (time, key) order.  The time at each position is selected
    first, then the key among the rows of exactly that time, so a timestamp that a third of the
    rows share is handled like any other.
    """
    clock = df.select(_clock(df, time).alias("t"), _ident(key).alias("k"))
    n, *extent = clock.agg(F.count("*"), F.min("t"), F.max("t")).first()
    spots = [int(n * e) for e in ends]
    inner = sorted({s for s in spots if s < n})
    if not inner:
        return [None] * len(spots)
    times = whole_at_ranks(clock, "t", inner, tuple(extent))
    cuts: dict[int, tuple[int, int]] = {}
    # A row per time that holds a position; where few rows share these times, their keys are fetched at once.
    shared = clock.where(F.col("t").isin(sorted({t for t, _ in times.values()})))
    sizes = {r.t: r for r in shared.groupBy("t").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    few = shared.collect() if sum(r.n for r in sizes.values()) <= CELLS else None
    for t, size in sizes.items():
        mine = {s: s - below for s, (at, below) in times.items() if at == t}
        if few is not None:
            ordered = sorted(r.k for r in few if r.t == t)
            cuts.update({s: (t, ordered[r]) for s, r in mine.items()})
        else:
            keys = whole_at_ranks(clock.where(F.col("t") == t), "k", sorted(mine.values()), (size.lo, size.hi))
            cuts.update({s: (t, keys[r][0]) for s, r in mine.items()})
    return [cuts.get(s) for s in spots]


def temporal_split(df: DataFrame, time: str, key: str, output: str = "split",
                   ends: tuple[float, ...] = (fixed.TRAIN_END, fixed.VALID_END)) -> DataFrame:
    """Rows labelled train / valid / test by comparing with two constants; nothing moves."""
    clock, ident = _clock(df, time), _ident(key)
    label: Column = F.lit(PARTS[0])
    for part, cut in zip(PARTS[1:], cut_points(df, time, key, ends)):
        if cut is not None:
            t, k = cut
            label = F.when((clock > t) | ((clock == t) & (ident >= k)), part).otherwise(label)
    return df.withColumn(output, label)


def split_summary(df: DataFrame, time: str, target: str, split: str = "split") -> DataFrame:
    """Rows, positives, negatives, rate and time range of each part."""
    y = F.sum(target).cast("bigint")
    return df.groupBy(split).agg(
        F.count("*").alias("total_rows"), y.alias("fraud"), (F.count("*") - y).alias("legitimate"),
        percent(y, F.count("*")).alias("fraud_rate"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
    )
