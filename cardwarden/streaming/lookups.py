"""Results with a lifetime, kept as keyed state of a stream.

Each id's state is the instant its short-lived entry expires and whether the permanent log holds it.
Requests of a micro-batch are answered in order of time, ties by request id; batches in the order
they come.  State survives restarts with the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardwarden import fixed
from cardwarden.functions.clock import SECOND, epoch_micros, whole_units

SCORE, GET, PUT, DELETE = "score", "get", "put", "delete"
GONE = -1


def answer(op: str, at: int, expires: int, logged: bool, lifetime: int) -> tuple[str | None, bool, int | None, int, bool]:
    """(source, found, ticks left, expires, logged) after one request.

    ``score`` is answered by the live entry, else by the log, which arms a new entry, else by the model.
    ``get`` only looks, ``put`` arms, ``delete`` drops the entry and leaves the log.
    """
    alive = at < expires
    left = expires - at if alive else None
    if op == SCORE:
        source = "cache" if alive else "database" if logged else "model"
        return source, alive, left, expires if alive else at + lifetime, True
    if op == PUT:
        return None, alive, left, at + lifetime, True
    if op == DELETE:
        return None, alive, left, GONE, logged
    if op == GET:
        return None, alive, left, expires, logged
    raise ValueError(f"unknown request {op}")


def answered(requests: DataFrame, key: str, time: str, request_id: str, ttl_seconds: float = fixed.STORE_TTL_SECONDS,
             op: Column | None = None, late_by: str | None = None, ticks_per_second: int = 1000) -> DataFrame:
    """(request id, key, op, source, found, remaining_seconds) of every request of a stream.

    ``op`` is one of ``score`` (the default), ``get``, ``put`` and ``delete``.  Requests without an id or
    a time ask for nothing and are left out.  With ``late_by`` a timer drops an entry's instant once the
    watermark has passed it, and requests later than that are not answered; without it state keeps one
    row per id and nothing is late.  A micro-batch bounds what an id brings at once.
    """
    lifetime = int(round(ttl_seconds * ticks_per_second))
    if lifetime <= 0:
        raise ValueError("the lifetime must be greater than zero")
    per_tick = SECOND // ticks_per_second
    micros = epoch_micros(F.col(time), requests.schema[time].dataType)
    rows = requests.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("key"), F.col(request_id).alias("rid"), whole_units(micros, per_tick).alias("at"),
        (F.lit(SCORE) if op is None else op).alias("op"), F.timestamp_micros(micros).alias("clock"))
    if late_by is not None:
        rows = rows.withWatermark("clock", late_by)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "rid")]

    def run(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expires, logged = state.get if state.exists else (GONE, False)
        if state.hasTimedOut:
            state.update((GONE, logged))
            return
        parts = list(batches)
        asked = parts[0] if len(parts) == 1 else pd.concat(parts)
        if len(asked) > 1:
            asked = asked.sort_values(["at", "rid"], kind="stable")
        # Groups are many and small: columns are made once, with their kinds.
        rids, whats, sources, founds, lefts = asked["rid"].to_numpy(), asked["op"].tolist(), [], [], []
        for at, what in zip(asked["at"].tolist(), whats):
            source, found, left, expires, logged = answer(what, int(at), expires, logged, lifetime)
            sources.append(source)
            founds.append(found)
            lefts.append(np.nan if left is None else left / ticks_per_second)
        state.update((expires, logged))
        if late_by is not None and expires != GONE:
            # Not before the watermark, which a timer may not precede.
            state.setTimeoutTimestamp(max(expires * 1000 // ticks_per_second, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [group[0]] * len(rids), "rid": rids, "op": whats, "source": np.array(sources, object),
                            "found": founds, "remaining_seconds": np.array(lefts)})

    made = rows.groupBy("key").applyInPandasWithState(
        run, f"key {kinds[0]}, rid {kinds[1]}, op string, source string, found boolean, remaining_seconds double",
        "expires bigint, logged boolean", "append",
        GroupStateTimeout.NoTimeout if late_by is None else GroupStateTimeout.EventTimeTimeout)
    return made.select(F.col("rid").alias(request_id), F.col("key").alias(key), "op", "source", "found",
                       F.nanvl("remaining_seconds", F.lit(None)).alias("remaining_seconds"))
