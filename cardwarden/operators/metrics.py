"""Operational counters, histograms, rates and quantiles over request and prediction logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.numeric import percent, ratio

INF = float("inf")


def labelled_counter(log: DataFrame, *labels: str) -> DataFrame:
    return log.groupBy(*labels).agg(F.count("*").alias("total"))


def histogram(log: DataFrame, value: str, bounds: list[float], by: list[str] = ()) -> DataFrame:
    """Cumulative buckets (le, cumulative) with ``+Inf``, plus sum and count per label set.

    One conditional counter per bound in a single aggregate: rows are not multiplied by bounds.
    """
    x = F.col(value)
    aggs = [F.count_if(x <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = log.groupBy(*by).agg(
        *aggs, F.count(x).alias("count"), F.coalesce(F.sum(x), F.lit(0.0)).alias("sum"))
    buckets = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative"))
               for i, b in enumerate(bounds)]
    buckets.append(F.struct(F.lit(INF).alias("le"), F.col("count").alias("cumulative")))
    return wide.select(*by, F.inline(F.array(*buckets)), "count", "sum")


def _interpolated(buckets: Column, n: Column, q: float, finite: int) -> Column:
    """The quantile read off cumulative buckets, linear inside the bucket that holds it.

    The lowest bucket starts at 0; a quantile beyond the last finite bound is that bound.
    """
    target = n * F.lit(q)
    i = F.array_position(F.transform(buckets, lambda b: b["cumulative"] >= target), True) - 1
    hit = F.get(buckets, i)
    start = F.coalesce(F.get(buckets, i - 1)["le"], F.lit(0.0))
    below = F.coalesce(F.get(buckets, i - 1)["cumulative"], F.lit(0))
    inside = hit["cumulative"] - below
    value = start + (hit["le"] - start) * F.when(inside > 0, (target - below) / inside).otherwise(1.0)
    top = F.get(buckets, F.lit(finite - 1))["le"]
    return F.when(n > 0, F.when(i >= finite, top).otherwise(value))


def histogram_quantiles(log: DataFrame, value: str, bounds: list[float], quantiles: list[float],
                        by: list[str] = ()) -> DataFrame:
    """(quantile, value) estimated from bucket counts; null without observations."""
    x = F.col(value)
    wide = log.groupBy(*by).agg(
        *[F.count_if(x <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.count(x).alias("n"))
    buckets = F.array(*[
        F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ], F.struct(F.lit(INF).alias("le"), F.col("n").alias("cumulative")))
    held = wide.select(*by, "n", buckets.alias("buckets"))
    rows = F.array(*[
        F.struct(F.lit(q).alias("quantile"),
                 _interpolated(F.col("buckets"), F.col("n"), q, len(bounds)).alias("value"))
        for q in quantiles
    ])
    return held.select(*by, F.inline(rows))


def rate_per_second(log: DataFrame, time: str, by: list[str] = (), every: str = "1 minute",
                    seconds: int = 60) -> DataFrame:
    """Events per second in fixed windows."""
    return log.groupBy(F.window(time, every).alias("w"), *by).agg(F.count("*").alias("events")).select(
        F.col("w.start").alias("minute"), *by, "events", (F.col("events") / seconds).alias("per_second"))


def hit_ratio(log: DataFrame, time: str, hit: Column, every: str = "1 minute") -> DataFrame:
    """Share of hits per window."""
    return log.groupBy(F.window(time, every).alias("w")).agg(
        F.count_if(hit).alias("hits"), F.count("*").alias("lookups")).select(
        F.col("w.start").alias("minute"), "hits", "lookups",
        ratio(F.col("hits"), F.col("lookups")).alias("hit_ratio"))


def flagged_total(log: DataFrame, decision: str = "decision") -> DataFrame:
    """Flagged predictions; 0 on an empty log."""
    return log.agg(F.count_if(F.col(decision) == fixed.REVIEW).alias("flagged"))


def kpis(log: DataFrame, decision: str = "decision", latency: str = "prediction_latency_ms") -> DataFrame:
    """Scored, flagged, flagged share and mean latency; zeros on an empty log."""
    flagged = F.count_if(F.col(decision) == fixed.REVIEW)
    return log.agg(
        F.count("*").alias("total"), flagged.alias("flagged"),
        percent(flagged, F.count("*")).alias("flagged_percentage"),
        F.coalesce(F.avg(latency), F.lit(0.0)).alias("mean_latency_ms"),
    )


def run_summary(sent: DataFrame, decision: str = "decision") -> DataFrame:
    """Sent, flagged, legitimate of a publishing run; any decision naming fraud counts as flagged."""
    flagged = F.count_if(F.lower(F.coalesce(F.col(decision), F.lit(""))).contains("fraud"))
    return sent.agg(
        F.count("*").alias("sent"), flagged.alias("flagged"), (F.count("*") - flagged).alias("legitimate"),
        percent(flagged, F.count("*")).alias("flagged_percentage"))
