import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.operators import counters


def by_hand(samples, step, window, start, end):
    """Rates of one series by walking every window."""
    out = {}
    for s in np.arange(start, end + 1e-9, step):
        inside = [(t, v) for t, v in sorted(samples) if s - window < t <= s]
        if len(inside) < 2:
            continue
        grown = inside[-1][1] - inside[0][1] + sum(a[1] for a, b in zip(inside, inside[1:]) if b[1] < a[1])
        sampled = inside[-1][0] - inside[0][0]
        spacing = sampled / (len(inside) - 1)
        head, tail = inside[0][0] - (s - window), s - inside[-1][0]
        if head >= 1.1 * spacing:
            head = spacing / 2
        if grown > 0 and inside[0][1] >= 0:
            head = min(head, sampled * inside[0][1] / grown)
        if tail >= 1.1 * spacing:
            tail = spacing / 2
        out[s] = grown * (sampled + head + tail) / sampled
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "who string, at double, v double")
    return df.select("who", F.timestamp_micros((F.col("at") * 1_000_000).cast("bigint")).alias("ts"), "v")


def at(seconds):
    return F.timestamp_micros(F.lit(int(seconds * 1_000_000)))


@pytest.mark.parametrize("step, window", [(60, 60), (15, 60), (100, 30), (7, 5000)])
def test_equals_walking_the_windows(spark, step, window):
    rng = np.random.default_rng(step)
    series = {}
    for who in ("a", "b"):
        t, v, held = 0.0, 0.0, []
        for _ in range(120):
            t += float(rng.choice([5, 15, 15, 15, 200]))
            v = 0.0 if rng.random() < 0.1 else v + float(rng.integers(0, 9))
            held.append((t, v))
        series[who] = held
    rows = [(w, t, v) for w, held in series.items() for t, v in held]
    got = counters.counter_rates(frame(spark, rows), "ts", "v", ["who"], at(0), at(4000), step, window).collect()
    want = {(w, s): x for w, held in series.items() for s, x in by_hand(held, step, window, 0, 4000).items()}
    found = {(r.who, r.step.timestamp()): r.increase for r in got}
    zone = min(s for _, s in found) - min(s for _, s in want)
    assert {(w, s - zone): x for (w, s), x in found.items()} == pytest.approx(want)
    assert all(math.isclose(r.per_second, r.increase / window) for r in got)


def test_blocks_carry_the_value_before(spark):
    """A reset is known by the sample before, also one of an earlier block of time, and in null series."""
    rows = [(None, 3599.0, 50.0), (None, 3601.0, 10.0), (None, 9000.0, 12.0), (None, 9000.0, 11.0), ("z", 1.0, None), (None, 9050.0, math.nan)]
    known = counters.with_previous(frame(spark, rows).select(
        "who", F.unix_micros("ts").alias("at"), "v"), ["who"]).orderBy("at").collect()
    assert [(r.v, r.prior) for r in known] == [(50.0, None), (10.0, 50.0), (12.0, 10.0)]


def test_ratio_and_empty(spark):
    rows = [("hit", t, t) for t in (0.0, 10.0, 20.0)] + [("miss", t, 3 * t) for t in (0.0, 10.0, 20.0)] + [("flat", t, 5.0) for t in (100.0, 110.0)]
    rates = counters.counter_rates(frame(spark, rows), "ts", "v", ["who"], at(20), at(120), 20, 20)
    got = [r.ratio for r in counters.rate_ratio(rates, F.col("who") == "hit").orderBy("step").collect()]
    assert got == pytest.approx([0.25, 0.0, 0.0][:len(got)]) and counters.summed_rates(rates).count() == len(got)
    assert counters.counter_rates(frame(spark, rows).where("false"), "ts", "v", ["who"], at(0), at(60)).count() == 0
    with pytest.raises(ValueError):
        counters.counter_rates(frame(spark, rows), "ts", "v", ["who"], at(0), at(60), 0)
