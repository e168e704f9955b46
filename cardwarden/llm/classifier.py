"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-Proximal.

Words are runs of letters and digits and runs of punctuation, A-Z in lower case; single words and
pairs are hashed into ``2 ** BITS`` weights.  Labelled rows are turned into sparse rows once and kept
as a table.  In each of ``EPOCHS`` rounds every part of that table runs follow-the-regularised-leader
updates, row by row in a fixed order, from the common state, and the parts' states are averaged.  A
text's score is a sparse dot product.  At most ``SAMPLE_ROWS`` labelled ids are learned from, spread over all by
their digests; a task holds the state, of fixed size, and one row at a time.

Null text counts as empty and scores like any other; rows without an id have no label.  Of several labels
of an id the greatest counts, null labels none, 1 is the positive class and all others negative.
Without a labelled row the state stays empty and every score is one half.  Repeated rows are rows of
their own, long texts are read whole, columns other than id and text play no part whatever their
names, an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import LOWER, as_bytes, map_batches
from cardwarden.session import materialise

BITS = 18
EPOCHS = 2
SAMPLE_ROWS = 20_000  # labelled ids that are learned from at most: those with the smallest digests
ROWS_PER_PART = 5_000
SLICES = 16
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
PAIR = np.uint64(0x9E3779B97F4A7C15)
STEP, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.01
POSITIVE = 1


def counted(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ascending slots of the words and pairs of a text, and how often each is hit."""
    tokens = TOKEN.findall(text.translate(LOWER)) if text else []
    one = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    with np.errstate(over="ignore"):
        hashed = np.concatenate([one * PAIR, (one[:-1] * PAIR + one[1:]) * PAIR + np.uint64(1)])
        hashed = (hashed ^ (hashed >> np.uint64(29))) * PAIR
    return np.unique((hashed >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)


def weighed(slots: np.ndarray, counts: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: logarithms of counts, scaled to length one; the last slot is the constant."""
    values = np.log1p(np.minimum(counts, 65_535).astype(float))
    if len(values):
        values = values / np.sqrt((values ** 2).sum())
    return np.append(slots, 1 << bits), np.append(values, 1.0)


def sparse(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    return weighed(*counted(text, bits), bits)


@dataclass
class Leader:
    """The state of FTRL-Proximal: per weight the shifted gradient sum and the squared sum."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls, bits: int = BITS) -> Leader:
        return cls(np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))

    def weights(self, slots: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / STEP + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(slots)
        g = weight * (probability(w @ values) - label) * values
        n = self.n[slots]
        after = n + g * g
        self.z[slots] += g - (np.sqrt(after) - np.sqrt(n)) / STEP * w
        self.n[slots] = after


def probability(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30.0, 30.0)))


def labelled_rows(docs: DataFrame, labels: DataFrame, held_out: Column, key: str, text: str, label: str, bits: int,
                  sample: int = SAMPLE_ROWS) -> DataFrame:
    """(order, label, slots, counts) of the rows to learn from, as a stored table.

    Ids are matched without their texts; the ids with the smallest digests, ``sample`` of them at most,
    are broadcast to the texts.  Of texts with one id the smallest is learned from.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        (F.max(label) == POSITIVE).cast("double").alias("label"))
    ids = docs.where(~held_out).select(F.col(f"`{key}`").alias("__key")).distinct().join(known, "__key")
    order = F.xxhash64("__key").alias("order")
    chosen = materialise(ids.select("__key", "label", order).orderBy("order", "__key").limit(sample), "chosen")
    rows = docs.where(~held_out).select(F.col(f"`{key}`").alias("__key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    mine = rows.join(F.broadcast(chosen.select("__key", "label", "order")), "__key").groupBy("__key", "label", "order").agg(
        F.min("text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [counted(t, bits) for t in as_bytes(batch, "text")]
        return pa.RecordBatch.from_pydict({
            "order": batch.column("order"), "label": batch.column("label"),
            "slots": pa.array([s.astype(np.int32).tobytes() for s, _ in found], pa.binary()),
            "counts": pa.array([np.minimum(c, 65_535).astype(np.uint16).tobytes() for _, c in found], pa.binary())})

    made = map_batches(mine.select("order", "label", "text"), run,
                       "order bigint, label double, slots binary, counts binary")
    return materialise(made, "labelled")


def unpacked(slots: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return weighed(np.frombuffer(slots, np.int32), np.frombuffer(counts, np.uint16), bits)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text",
        label: str = "quality", bits: int = BITS, epochs: int = EPOCHS, rows_per_part: int = ROWS_PER_PART,
        sample: int = SAMPLE_ROWS) -> np.ndarray:
    """The weights; the last is the constant's.  Classes weigh the same in sum."""
    rows = labelled_rows(docs, labels, held_out, key, text, label, bits, sample)
    size = rows.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).first()
    leader = Leader.empty(bits)
    if not size.n:
        return leader.weights()
    share = {1.0: size.n / 2 / max(size.pos, 1), 0.0: size.n / 2 / max(size.n - size.pos, 1)}
    parts = -(-size.n // rows_per_part)
    for epoch in range(epochs):
        # Another order in every round, the same in every run.
        turn = F.xxhash64("order", F.lit(epoch))
        placed = rows.repartition(parts, "order").sortWithinPartitions(turn, "order", "label")
        leader = averaged(placed, leader, share, bits)
    return leader.weights()


def averaged(rows: DataFrame, leader: Leader, share: dict[float, float], bits: int) -> Leader:
    """The mean of the states that the partitions of ``rows`` come to from a common one.

    A part gives its changes by slices of the slots; the slices are added up apart, as many of each
    as there are parts (``SAMPLE_ROWS / ROWS_PER_PART``), and the driver gets one state, of fixed size.
    """
    width = len(leader.z)
    step = -(-width // SLICES)
    shared = rows.sparkSession.sparkContext.broadcast((leader.z, leader.n))

    def run(batches):
        start = shared.value
        mine, seen = Leader(*[v.copy() for v in start]), 0
        for batch in batches:
            for y, s, c in zip(*[batch.column(c).to_pylist() for c in ("label", "slots", "counts")]):
                mine.learn(*unpacked(s, c, bits), y, share[y])
                seen += 1
        if seen:
            part = TaskContext.get().partitionId()
            moved = [np.pad(after - before, (0, SLICES * step - width)).reshape(SLICES, step)
                     for after, before in zip((mine.z, mine.n), start)]
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(range(SLICES), pa.int32()), "part": pa.array([part] * SLICES, pa.int32()),
                **{c: pa.array([r.tobytes() for r in m], pa.binary()) for c, m in zip("zn", moved)}})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        sums = [np.sum([np.frombuffer(b) for b in pdf[c]], axis=0) / len(pdf) for c in "zn"]
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "z": [sums[0].tobytes()], "n": [sums[1].tobytes()]})

    made = rows.mapInArrow(run, "slice int, part int, z binary, n binary")
    means = sorted(made.groupBy("slice").applyInPandas(add, "slice int, z binary, n binary").collect())
    shared.unpersist()
    return Leader(*[v + np.concatenate([np.frombuffer(bytes(m[i])) for m in means])[:width]
                    for i, v in ((1, leader.z), (2, leader.n))])


def scored(docs: DataFrame, weights: np.ndarray, held_out: Column, key: str = "doc_id", text: str = "text",
           bits: int = BITS) -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = shared.value
        margins = np.array([w[s] @ v for s, v in (sparse(t, bits) for t in as_bytes(batch, "text"))])
        p = probability(margins)
        return pa.RecordBatch.from_pydict({
            "key": batch.column("key"), "held_out": batch.column("held_out"), "score": pa.array(p),
            "predicted": pa.array((p >= 0.5).astype(np.int32))})

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(f"`{text}`").alias("text"))
    return map_batches(rows, run, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)


def judged(docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text",
           label: str = "quality") -> DataFrame:
    """Every document scored by a classifier that learned from the labels of rows not held out."""
    return scored(docs, fit(docs, labels, F.coalesce(held_out, F.lit(True)), key, text, label), held_out, key, text)
