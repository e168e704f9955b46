"""Boosted trees of second order on histograms, grown by Spark.

Values are put into at most ``bins`` cells around cuts of a weighted quantile summary.  A level of a
tree is one job: every block of rows adds gradients and Hessians by (node, feature, cell), the sums
of a feature meet in one reducer, and only the best split of each node and feature reaches the
driver; few bytes of sums are added up there.  Rows never move; a block keeps its margins, checkpointed
in the shared folder.  Sums are taken in whole numbers, so blocks, retries and orders cannot change a tree.

Rows equal in all cells, label and weight have one margin and one gradient for good, so a block holds
them as one entry with the numbers of its rows; what a tree draws of an entry is a count.  A table of
``ENTRIES_A_TASK`` entries at most has nothing to exchange: sums are complete inside one task, which
grows up to ``TREES_PER_JOB`` trees a job by the same steps.  The rows stay where they are, spread over
all tasks, which count the draws of these trees.

A job per level costs more than its sums where the entries fit into the memory of tasks that run at the same
time.  Such a table is dealt out to the tasks of one barrier stage, which grow all trees and add up
their sums of each level through small files in the shared folder, if that is a mounted one.
"""

from __future__ import annotations

import math
import os
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.session import fill_cores, materialise, mounted, tasks_at_once, use_checkpoints, work_path

ROWS_PER_BLOCK = 1 << 20
TREES_PER_JOB = 500
# Entries from which tasks grow side by side, and how many of them a task holds in memory.
ENTRIES_A_TASK, ENTRIES_AT_ONCE = 1 << 17, 1 << 22
# Seconds between two looks for a file, and until a task gives up on another one.
LOOK_SECONDS, WAIT_SECONDS = 0.0005, 900
# Rows from which another task counts draws, bytes of counts that a job of many trees takes at most.
DRAW_ROWS, DRAWN_BYTES = 1 << 16, 1 << 25
CHECKPOINT_TREES = 10
BYTES_TO_DRIVER = 1 << 25
BUNDLE_CODES = 1024
# Rows a joint code from which two bundles are added up in one pass.
PAIR_ROWS = 1
# Few enough for a core's cache: rows whose gradients are worked out together, trees that a chunk of rows goes down together.
ROWS_AT_ONCE, TREES_AT_ONCE = 1 << 14, 16
CELL_MARGINS, CUT_ROWS, STAGED_TREES = 1 << 20, 4096, 100
LEAST_GAIN = 1e-6
SUMMARY, FAN_IN = 2048, 64


@dataclass(frozen=True)
class Settings:
    """How trees are grown; shares are of all rows or columns, drawn anew for every tree."""

    trees: int
    depth: int = 6
    rate: float = 0.05
    row_share: float = 1.0
    column_share: float = 1.0
    child_weight: float = 1.0
    least_gain: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    bins: int = 256
    seed: int = 0

    def __post_init__(self):
        if not (1 <= self.depth <= 12 and self.trees >= 1 and 3 <= self.bins <= 256):
            raise ValueError(f"settings out of range: {self}")
        if not (0 < self.row_share <= 1 and 0 < self.column_share <= 1):
            raise ValueError("shares lie in (0, 1]")


@dataclass
class Forest:
    """All trees as arrays (tree, node); the children of node i are 2i + 1 and 2i + 2.

    ``feature`` is -1 in leaves.  A row goes left when its value is below ``cut``, or is missing and
    ``missing_left`` is set.  ``value`` is what a leaf adds to the margin, ``cover`` the Hessian sum.
    """

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    width: int

    COLUMNS = ["feature", "cut", "missing_left", "value", "cover", "gain"]

    @property
    def depth(self) -> int:
        return int(math.log2(self.feature.shape[1] + 1)) - 1

    def __len__(self) -> int:
        return len(self.feature)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """What every tree adds to the margin of every row: (rows, trees)."""
        trees, nodes = self.feature.shape
        out, gaps = np.empty((len(x), trees)), np.isnan(x).any()
        # A leaf leads to itself: no value is below its cut.
        leaf = self.feature < 0
        feature, cut = np.where(leaf, 0, self.feature).ravel(), np.where(leaf, -np.inf, self.cut).ravel()
        place = np.arange(trees * nodes).reshape(trees, nodes)
        right = np.where(leaf, place, place + np.arange(nodes) + 2).ravel()
        missing_left, value = (self.missing_left & ~leaf).ravel(), self.value.ravel()
        flat, rows = x.ravel(), np.arange(len(x))[:, None] * x.shape[1]
        for first in range(0, trees, TREES_AT_ONCE):
            start = np.arange(first, min(first + TREES_AT_ONCE, trees), dtype=np.int64) * nodes
            at = np.broadcast_to(start, (len(x), len(start)))
            for _ in range(self.depth):
                v = flat.take(feature.take(at, mode="clip") + rows, mode="clip")
                left = v < cut.take(at, mode="clip")
                if gaps:
                    left |= np.isnan(v) & missing_left.take(at, mode="clip")
                at = right.take(at, mode="clip") - left
            out[:, first:first + len(start)] = value.take(at, mode="clip")
        return out

    def margins(self, x: np.ndarray, chunk: int = 2048) -> np.ndarray:
        out = np.zeros(len(x))
        for i in range(0, len(x), chunk):
            out[i:i + chunk] = self.leaves(x[i:i + chunk]).sum(axis=1)
        return out

    def importance(self) -> np.ndarray:
        """Mean gain of the splits on each feature, as shares of one."""
        split = self.feature >= 0
        total = np.bincount(self.feature[split], self.gain[split], minlength=self.width)
        mean = total / np.maximum(np.bincount(self.feature[split], minlength=self.width), 1)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def save(self, spark: SparkSession, path: str) -> None:
        tree, node = np.nonzero(self.cover > 0)
        table = pd.DataFrame({"tree": tree, "node": node, **{c: getattr(self, c)[tree, node] for c in self.COLUMNS}})
        spark.createDataFrame(table).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, trees: int, depth: int, width: int) -> Forest:
        """Read back; bounded by trees × nodes."""
        forest = cls.empty(trees, depth, width)
        t = spark.read.parquet(path).toPandas()
        for c in cls.COLUMNS:
            getattr(forest, c)[t.tree, t.node] = t[c]
        return forest

    @classmethod
    def empty(cls, trees: int, depth: int, width: int) -> Forest:
        shape = (trees, 2 ** (depth + 1) - 1)
        return cls(np.full(shape, -1, np.int64), np.full(shape, np.nan), np.zeros(shape, bool),
                   np.zeros(shape), np.zeros(shape), np.zeros(shape), width)


# --- cuts -----------------------------------------------------------------------------------------
# A summary is an array of (value, least rank, greatest rank, weight), ascending by value.

def summary_of(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact summary of the present values."""
    here = ~np.isnan(values)
    distinct, which = np.unique(values[here], return_inverse=True)
    weight = np.bincount(which, weights[here], minlength=len(distinct))
    through = np.cumsum(weight)
    return np.column_stack([distinct, through - weight, through, weight])


def merged(parts: list[np.ndarray]) -> np.ndarray:
    """One summary of several; rank bounds add up."""
    parts = [p for p in parts if len(p)]
    if len(parts) <= 1:
        return parts[0] if parts else np.empty((0, 4))
    values = np.unique(np.concatenate([p[:, 0] for p in parts]))
    out = np.zeros((len(values), 4))
    out[:, 0] = values
    for p in parts:
        at = np.searchsorted(p[:, 0], values)
        inside = np.minimum(at, len(p) - 1)
        same = p[inside, 0] == values
        before = at - 1
        below = np.where(before >= 0, p[before, 1] + p[before, 3], 0.0)
        above = np.where(at < len(p), p[inside, 2] - p[inside, 3], p[-1, 2])
        out[:, 1] += np.where(same, p[inside, 1], below)
        out[:, 2] += np.where(same, p[inside, 2], above)
        out[:, 3] += np.where(same, p[inside, 3], 0.0)
    return out


def pruned(summary: np.ndarray, size: int = SUMMARY) -> np.ndarray:
    """At most ``size`` entries; each rank is off by at most the total weight over ``size`` more."""
    if len(summary) <= size:
        return summary
    middle = (summary[:, 1] + summary[:, 2]) / 2
    wanted = np.linspace(middle[0], middle[-1], size)
    return summary[np.unique(np.clip(np.searchsorted(middle, wanted), 0, len(summary) - 1))]


def cuts_of(summary: np.ndarray, bins: int) -> np.ndarray:
    """Lower bounds of all cells but the first: one cell per distinct value where they are few."""
    most = bins - 2  # one cell fewer than cuts + 1, one cell for missing values
    return pruned(summary, most + 1)[1:, 0]


def feature_cuts(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Cuts of every feature of (x array, weight): summaries by task, merged ``FAN_IN`` at a time."""
    def summarise(batches):
        kept: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = matrix(batch.column("x")), batch.column("weight").to_numpy()
            kept = kept or [[] for _ in range(x.shape[1])]
            for f, held in enumerate(kept):
                held.append(pruned(summary_of(x[:, f], w)))
                if len(held) == FAN_IN:
                    held[:] = [pruned(merged(held))]
        part = TaskContext.get().partitionId()
        data = [pruned(merged(held)).tobytes() for held in kept]
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(range(len(data)), pa.int32()), "part": pa.array([part] * len(data), pa.int32()),
            "data": pa.array(data, pa.binary())})

    made = rows.select("x", "weight").mapInArrow(summarise, "feature int, part int, data binary")
    parts = rows.rdd.getNumPartitions()
    pairs = made.rdd.map(lambda r: ((r.feature, r.part), np.frombuffer(bytes(r.data)).reshape(-1, 4)))
    while True:
        parts = math.ceil(parts / FAN_IN)
        pairs = pairs.map(lambda kv: ((kv[0][0], kv[0][1] // FAN_IN), kv[1])).groupByKey(
            max(1, min(parts * 16, 200))).mapValues(lambda some: pruned(merged(list(some))))
        if parts <= 1:
            break
    found = dict(pairs.map(lambda kv: (kv[0][0], cuts_of(kv[1], bins))).collect())
    return [found[f] for f in range(len(found))]


def matrix(column: pa.Array) -> np.ndarray:
    """An array column of equal lengths as (rows, features)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def cells(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(features, rows): the number of cuts at or below the value; one more than all cuts if missing."""
    out = np.empty(x.shape[::-1], np.uint8)
    for f, edges in enumerate(cuts):
        out[f] = np.searchsorted(edges, x[:, f], side="right")
        out[f, np.isnan(x[:, f])] = len(edges) + 1
    return out


# --- one tree -------------------------------------------------------------------------------------

def _mixed(row: np.ndarray, salt: int) -> np.ndarray:
    z = row.astype(np.uint64)
    with np.errstate(over="ignore"):
        z += np.uint64((salt + 0x9E3779B97F4A7C15) % 2 ** 64)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xBF58476D1CE4E5B9)
    return z


def mix(row: np.ndarray, salt: int) -> np.ndarray:
    """A uniform number in [0, 1) per row and salt, the same wherever the row lies."""
    return (_mixed(row, salt) >> np.uint64(11)).astype(float) / 2.0 ** 53


def below_share(row: np.ndarray, salt: int, share: float) -> np.ndarray:
    """``mix(row, salt) < share``, compared as whole numbers."""
    end = math.ceil(share * 2.0 ** 53) << 11
    return _mixed(row, salt) < np.uint64(end) if end < 1 << 64 else np.ones(len(row), bool)


def drawn_columns(s: Settings, tree: int, width: int) -> np.ndarray:
    order = np.random.default_rng((s.seed, tree)).permutation(width)
    return np.sort(order[:max(1, int(s.column_share * width))])


def whole_scale(total_weight: float) -> float:
    """A power of two by which sums of rounded gradients stay whole and exact in double precision."""
    return 2.0 ** min(40, 51 - math.ceil(math.log2(max(total_weight, 1.0))))


def gradients(block, margin: np.ndarray, s: Settings, tree: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-number gradients and Hessians of rows, and which of them the tree draws."""
    gh = joint_gradients(*block[2:4], margin, scale)
    return gh.real, gh.imag, drawn_rows(block[1], s, tree)


def joint_gradients(label: np.ndarray, weight: np.ndarray, margin: np.ndarray, scale: float) -> np.ndarray:
    """Gradients and Hessians as the two parts of complex numbers; some rows at a time."""
    gh = np.empty(len(margin), complex)
    for i in range(0, len(margin), ROWS_AT_ONCE):
        some = slice(i, i + ROWS_AT_ONCE)
        p = np.negative(margin[some])
        np.exp(p, out=p)
        p += 1.0
        np.divide(1.0, p, out=p)
        scaled = weight[some] * scale  # a power of two, so the place of this factor changes no bit
        np.rint(scaled * (p - label[some]), out=gh.real[some])
        scaled *= p
        scaled *= np.subtract(1.0, p, out=p)
        np.rint(scaled, out=gh.imag[some])
    return gh


def drawn_rows(row: np.ndarray, s: Settings, tree: int) -> np.ndarray:
    drawn = np.empty(len(row), bool)
    for i in range(0, len(row), ROWS_AT_ONCE):
        some = slice(i, i + ROWS_AT_ONCE)
        drawn[some] = below_share(row[some], (s.seed + 1) * 1_000_003 + tree * 7919, s.row_share)
    return drawn


def drawn_counts(row: np.ndarray, starts: np.ndarray, s: Settings, tree: int) -> np.ndarray:
    """How many rows of each entry the tree draws; an entry's rows begin at its start."""
    drawn = drawn_rows(row, s, tree)
    if len(starts) == len(row):
        return drawn.view(np.uint8)
    through = np.cumsum(drawn, dtype=np.int64)
    counts = np.diff(through[np.append(starts[1:], len(row)) - 1], prepend=0)
    return counts.astype(np.uint8 if np.diff(starts, append=len(row)).max() < 256 else np.int64)


def weighed(gh: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries' gradients times their drawn rows, whole as before; those of entries without one are not looked at."""
    if counts.max(initial=0) <= 1:
        return gh
    gh.real *= counts
    gh.imag *= counts
    return gh


def leaf_weight(g, h, s: Settings):
    return -np.sign(g) * np.maximum(np.abs(g) - s.l1, 0.0) / (h + s.l2)


def score(g, h, s: Settings):
    return np.maximum(np.abs(g) - s.l1, 0.0) ** 2 / (h + s.l2)


SPLIT = np.dtype([("gain", float), ("feature", np.int64), ("cell", np.int64), ("missing_left", bool),
                  ("gl", float), ("hl", float), ("g", float), ("h", float)])


def best_by_feature(sums: np.ndarray, columns: np.ndarray, widths: np.ndarray, s: Settings, scale: float) -> np.ndarray:
    """The best split of every (slot, column); among equals missing right, then the lowest cell.

    The last cell of a column is that of missing values; a split at the last other cell parts the
    missing from the present.
    """
    size = widths[columns]
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(columns)), size)
    place = np.arange(len(owner))
    g, h = total = sums[:, :, :size[0]].sum(axis=2, keepdims=True)
    absent = sums[:, :, starts + size - 1]
    # Every column's cells add up to the node's total, so one running sum serves all columns.
    steps = sums.copy()
    steps[:, :, starts[1:]] -= total
    below = np.cumsum(steps, axis=2)
    inner = place != (starts + size - 1)[owner]

    def best_side(left):
        gl, hl = left / scale
        gr, hr = g / scale - gl, h / scale - hl
        ok = inner & (hl >= s.child_weight) & (hr >= s.child_weight) & (hl > 0) & (hr > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = score(gl, hl, s) + score(gr, hr, s) - score(g / scale, h / scale, s)
        gain = np.where(ok, gain, -np.inf)
        top = np.maximum.reduceat(gain, starts, axis=1)
        at = np.minimum.reduceat(np.where(gain == top[:, owner], place, len(place)), starts, axis=1)
        rows = np.arange(len(gain))[:, None]
        return top, at - starts, gl[rows, at], hl[rows, at]

    found = best_side(below)
    side = np.zeros(found[0].shape, bool)
    if absent[1].any():
        other = best_side(below + absent[:, :, owner])
        side = other[0] > found[0]
        found = [np.where(side, o, f) for o, f in zip(other, found)]
    out = np.empty(side.shape, SPLIT)
    out["gain"], out["cell"], out["gl"], out["hl"] = found
    out["feature"], out["missing_left"], out["g"], out["h"] = columns, side, g / scale, h / scale
    return out


def best_of(candidates: np.ndarray) -> np.ndarray:
    """Per slot the best column, the first among equals."""
    return candidates[np.arange(len(candidates)), candidates["gain"].argmax(axis=1)]


def grow_tree(split_nodes, forest: Forest, t: int, cell: np.ndarray, cuts: list[np.ndarray], s: Settings) -> None:
    """Tree ``t``, level by level; ``split_nodes(nodes)`` gives the best split of each open node."""
    open_nodes, sums = [0], {}
    for _ in range(s.depth):
        following = []
        for node, b in zip(open_nodes, split_nodes(open_nodes)):
            sums[node] = (b["g"], b["h"])
            if b["gain"] > LEAST_GAIN and b["gain"] >= s.least_gain:
                forest.feature[t, node], forest.gain[t, node] = b["feature"], b["gain"]
                forest.missing_left[t, node] = b["missing_left"]
                cell[node] = b["cell"]
                edges = cuts[b["feature"]]
                forest.cut[t, node] = edges[b["cell"]] if b["cell"] < len(edges) else np.inf
                sums[2 * node + 1] = (b["gl"], b["hl"])
                sums[2 * node + 2] = (b["g"] - b["gl"], b["h"] - b["hl"])
                following += [2 * node + 1, 2 * node + 2]
        open_nodes = following
        if not open_nodes:
            break
    for node, (g, h) in sums.items():
        forest.cover[t, node] = h
        if forest.feature[t, node] < 0:
            forest.value[t, node] = s.rate * leaf_weight(g, h, s)


# --- growing --------------------------------------------------------------------------------------

def bundled(bins: np.ndarray, widths: np.ndarray) -> list[tuple]:
    """Columns of few cells put together: (code of every row, number of codes, columns, their cells by code).

    A code is a combination of cells that occurs in the block, so one count serves all columns of a
    bundle; adding up its codes by cell gives the columns' own sums, exactly.
    """
    found = []
    code, codes, columns, parts = None, 1, [], []
    for f in np.argsort(widths, kind="stable"):
        column = bins[f].astype(np.uint16)
        joint = column if code is None else None
        if code is not None and codes * int(widths[f]) <= 1 << 16:
            joint = code * np.uint16(widths[f]) + column
            seen = np.flatnonzero(np.bincount(joint, minlength=1))
            if len(seen) > BUNDLE_CODES:
                joint = None
        if joint is None:
            found.append((code, codes, columns, parts))
            code, codes, columns, parts = column, int(widths[f]), [f], [np.arange(widths[f])]
        elif code is None:
            code, codes, columns, parts = column, int(widths[f]), [f], [np.arange(widths[f])]
        else:
            place = np.zeros(codes * int(widths[f]), np.uint16)
            place[seen] = np.arange(len(seen))
            code, codes, columns = place[joint], len(seen), [*columns, f]
            parts = [*[part[seen // widths[f]] for part in parts], seen % widths[f]]
    return [*found, (code, codes, columns, parts)]


def paired(bundles: list[tuple]) -> list[tuple]:
    """Bundles two by two, the shortest with the longest: (codes of both in one number or None, their numbers).

    Where a node has many rows, one pass over the joint codes is less than two over the bundles.
    """
    order, found = sorted(range(len(bundles)), key=lambda i: bundles[i][1]), []
    while order:
        one, *other = [order.pop(0), *([order.pop()] if order else [])]
        joint = None
        if other and bundles[one][1] * bundles[other[0]][1] <= 1 << 16:
            joint = bundles[one][0].astype(np.uint16) * np.uint16(bundles[other[0]][1]) + bundles[other[0]][0].astype(np.uint16)
        found.append((joint, [one, *other]))
    return found


def node_sums(bundles: list[tuple], rows: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """(2, cells of all columns): sums over a node's rows, a column after the other."""
    gh = np.empty(len(g), complex)
    gh.real, gh.imag = g, h
    return joint_sums(bundles, paired(bundles), rows, gh, columns, widths)


def joint_sums(bundles: list[tuple], pairs: list[tuple], rows: np.ndarray, gh: np.ndarray, columns: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """``node_sums`` of gradients and Hessians as parts of complex numbers, which are added in one pass."""
    ends = np.cumsum(widths[columns])
    place = {f: slice(end - widths[f], end) for f, end in zip(columns, ends)}
    out = np.zeros((2, ends[-1]))
    gh = gh.take(rows, mode="clip")

    def total(code: np.ndarray, codes: int) -> np.ndarray:
        both = np.zeros(codes, complex)
        np.add.at(both, code.take(rows, mode="clip").astype(np.intp), gh)
        return both

    for joint, members in pairs:
        needed = [i for i in members if any(f in place for f in bundles[i][2])]
        size = [bundles[i][1] for i in members]
        if joint is not None and len(needed) == 2 and len(rows) >= PAIR_ROWS * size[0] * size[1]:
            both = total(joint, size[0] * size[1]).reshape(size)
            sums = dict(zip(members, (both.sum(axis=1), both.sum(axis=0))))
        else:
            sums = {i: total(*bundles[i][:2]) for i in needed}
        for i, both in sums.items():
            both = np.ascontiguousarray(both.real), np.ascontiguousarray(both.imag)
            for f, part in zip(*bundles[i][2:]):
                if f in place:
                    for k in (0, 1):
                        out[k, place[f]] = both[k] if len(bundles[i][2]) == 1 else np.bincount(part, both[k], minlength=widths[f])
    return out


def goes_left(bins: np.ndarray, widths: np.ndarray, rows: np.ndarray, feature: int, cell: int, missing_left: bool) -> np.ndarray:
    v = bins[feature].take(rows, mode="clip")  # row numbers are in range; the other mode copies to be sure
    left = v <= cell
    if missing_left:
        left |= v == widths[feature] - 1
    return left


def parted(bins: np.ndarray, widths: np.ndarray, rows: np.ndarray, feature: int, cell: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
    """A split node's rows, left and right."""
    left = goes_left(bins, widths, rows, feature, cell, missing_left)
    return rows.compress(left), rows.compress(~left)


def split_by_sums(count: Callable[[list[int]], np.ndarray], columns: np.ndarray, widths: np.ndarray, s: Settings, scale: float):
    """The best splits of the open nodes of a level, from ``count(nodes)``: (2, nodes, cells of the columns).

    Only the lighter child of a split node is counted; the other is the rest of the parent.
    """
    held: dict[int, np.ndarray] = {}
    splits: dict[int, np.void] = {}

    def split_nodes(nodes):
        nonlocal held, splits
        small = [0] if nodes == [0] else [n if 2 * splits[n // 2]["hl"] <= splits[n // 2]["h"] else n + 1 for n in nodes[::2]]
        sums = count(small)
        now = {n: sums[:, i] for i, n in enumerate(small)}
        for n in nodes:
            if n not in now:
                sibling = n + 1 if n % 2 else n - 1
                now[n] = held[(n - 1) // 2] - now[sibling]
        held = now
        best = best_of(best_by_feature(np.stack([now[n] for n in nodes], axis=1), columns, widths, s, scale))
        splits = dict(zip(nodes, best))
        return best
    return split_nodes


def rows_of(bins: np.ndarray, widths: np.ndarray, rows: np.ndarray, tree, nodes: list[int]) -> dict[int, np.ndarray]:
    """The rows that lie in each of the nodes of a level."""
    path = [nodes]
    while path[-1] != [0]:
        path.append(sorted({(n - 1) // 2 for n in path[-1]}))
    level = {0: rows}
    for parents in path[:0:-1]:
        level = {n: part for p in parents for n, part in zip(
            (2 * p + 1, 2 * p + 2), parted(bins, widths, level[p], *[a[p] for a in tree]))}
    return level


def add_values(margin: np.ndarray, bins: np.ndarray, widths: np.ndarray, tree, value: np.ndarray, members: Iterable[tuple[int, np.ndarray]]) -> None:
    """A tree's leaf values added to the margins of the rows below the given nodes; a row is below one of them at most."""
    open_nodes, added = list(members), np.zeros(len(margin))
    while open_nodes:
        node, rows = open_nodes.pop()
        if tree[0][node] < 0:
            added[rows] = value[node]
        elif len(rows) and tree[0][2 * node + 1] < 0 and tree[0][2 * node + 2] < 0:
            left = goes_left(bins, widths, rows, *[a[node] for a in tree])
            added[rows] = np.where(left, value[2 * node + 1], value[2 * node + 2])
        elif len(rows):
            open_nodes += zip((2 * node + 1, 2 * node + 2), parted(bins, widths, rows, *[a[node] for a in tree]))
    margin += added


def grow_here(block, margin: np.ndarray, drawn: Iterable[np.ndarray], trees: range, cuts, s: Settings, scale: float,
              total: Callable[[np.ndarray], np.ndarray] = lambda sums: sums) -> tuple[Forest, np.ndarray]:
    """The trees, given the entries' counts of each, from the total of one block's own sums; and its new margin."""
    bins, label, weight, bundles, pairs = block
    widths, forest, first = widths_of(cuts), Forest.empty(len(trees), s.depth, len(bins)), trees.start
    margin = margin.copy()
    for t, counts in enumerate(drawn):
        columns = drawn_columns(s, first + t, len(bins))
        gh = weighed(joint_gradients(label, weight, margin, scale), counts)
        cell = np.zeros(forest.feature.shape[1], np.int64)
        tree = (forest.feature[t], cell, forest.missing_left[t])
        members = {0: np.flatnonzero(counts)}

        def counted(small, tree=tree, columns=columns, gh=gh, members=members):
            for p in [(n - 1) // 2 for n in small if n]:
                members[2 * p + 1], members[2 * p + 2] = parted(bins, widths, members.pop(p), *[a[p] for a in tree])
            return total(np.stack([joint_sums(bundles, pairs, members[n], gh, columns, widths) for n in small], axis=1))

        grow_tree(split_by_sums(counted, columns, widths, s, scale), forest, t, cell, cuts, s)
        # The last level's splits and the entries without a drawn row are still to be walked.
        add_values(margin, bins, widths, tree, forest.value[t], [*members.items(), (0, np.flatnonzero(counts == 0))])
    return forest, margin


def widths_of(cuts) -> np.ndarray:
    return np.array([len(c) + 2 for c in cuts])


def grow_apart(state: RDD, forest: Forest, t: int, cuts, s: Settings, scale: float, reducers: int) -> tuple:
    """Tree ``t`` over all blocks, a job per level; gives the tree's shape for the margins' update."""
    columns, widths = drawn_columns(s, t, forest.width), widths_of(cuts)
    cell = np.zeros(forest.feature.shape[1], np.int64)
    spread = max(1, min(reducers, len(columns)))

    def local(pair, tree, nodes):
        (bins, label, weight, bundles, pairs, row, starts), margin = pair
        counts = drawn_counts(row, starts, s, t)
        gh = weighed(joint_gradients(label, weight, margin, scale), counts)
        members = rows_of(bins, widths, np.flatnonzero(counts), tree, nodes)
        return np.stack([joint_sums(bundles, pairs, members[n], gh, columns, widths) for n in nodes], axis=1)

    def shape():
        return forest.feature[t].copy(), cell.copy(), forest.missing_left[t].copy()

    def collected(nodes):
        tree = shape()
        return sum(state.map(lambda pair: local(pair, tree, nodes)).collect())

    def reduced(nodes):
        tree, ends = shape(), np.cumsum(widths[columns])[:-1]
        every = state.flatMap(lambda pair: enumerate(np.split(local(pair, tree, nodes), ends, axis=2)))
        found = dict(every.reduceByKey(np.add, spread).map(lambda pair: (
            pair[0], best_by_feature(pair[1], columns[pair[0]:pair[0] + 1], widths, s, scale)[:, 0])).collect())
        return best_of(np.stack([found[i] for i in range(len(columns))], axis=1))

    # Where all blocks' sums of a level are few bytes they are added up on the driver, which saves a shuffle.
    few = sums_of_a_level(cuts, s) * state.getNumPartitions() <= BYTES_TO_DRIVER
    grow_tree(split_by_sums(collected, columns, widths, s, scale) if few else reduced, forest, t, cell, cuts, s)
    return shape()


def packed(rows: DataFrame, cuts: list[np.ndarray], parts: int) -> RDD:
    """One block (cells, label, weight by entry; row numbers, each entry's first one) per partition.

    Rows are dealt in ranges of all that makes an entry and the row number, so an entry of very many
    rows spreads over several blocks, where it is an entry of each.
    """
    names = ["bins", "label", "weight", "row"]

    def put(batches):
        for b in batches:
            if b.num_rows:
                bins = np.ascontiguousarray(cells(matrix(b.column("x")), cuts).T)
                bins = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), len(bins), [None, pa.py_buffer(bins)])
                yield pa.RecordBatch.from_arrays([bins.cast(pa.binary()), *[b.column(c) for c in names[1:]]], names)

    def pack(batches):
        got = [(np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(b.num_rows, -1),
                *[b.column(c).to_numpy() for c in names[1:]]) for b in batches if b.num_rows]
        if got:
            bins, label, weight, row = (np.concatenate(a) for a in zip(*got))
            other = (label[1:] != label[:-1]) | (weight[1:] != weight[:-1])
            for f in range(bins.shape[1]):
                other |= bins[1:, f] != bins[:-1, f]
            starts = np.flatnonzero(np.append(True, other))
            made = {"bins": np.ascontiguousarray(bins[starts].T), "label": label[starts], "weight": weight[starts],
                    "row": row.astype(np.int64), "starts": starts}
            yield pa.RecordBatch.from_pydict({c: pa.array([v.tobytes()], pa.binary()) for c, v in made.items()})

    # Stored, as ranges are found by a pass of their own.
    made = materialise(rows.select("x", *names[1:]).mapInArrow(
        put, "bins binary, label double, weight double, row bigint"), "cells").repartitionByRange(
        parts, *names).sortWithinPartitions(*names).mapInArrow(
        pack, "bins binary, label binary, weight binary, row binary, starts binary")
    return made.rdd.map(lambda r: (
        np.frombuffer(bytes(r.bins), np.uint8).reshape(len(cuts), -1), np.frombuffer(bytes(r.label)), np.frombuffer(bytes(r.weight)),
        np.frombuffer(bytes(r.row), np.int64), np.frombuffer(bytes(r.starts), np.int64)))


def counted_together(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, widths: np.ndarray) -> tuple:
    """A block's entries, ready to be added up: (cells, label, weight, bundles, pairs)."""
    bundles = bundled(bins, widths)
    return bins, label, weight, bundles, paired(bundles)


def in_one_task(blocks: RDD, some: Callable[[tuple], tuple]) -> RDD:
    """Arrays of every block, joined along their last axis in the blocks' order, as one element."""
    def joined(parts):
        parts = [arrays for _, arrays in sorted(parts, key=lambda part: part[0])]
        return [tuple(np.concatenate(a, axis=-1) for a in zip(*parts))]
    return blocks.mapPartitionsWithIndex(lambda i, found: [(i, some(block)) for block in found]).repartition(1).mapPartitions(joined)


def stored(rdd: RDD) -> RDD:
    """Computed once and kept in the checkpoint folder, where a lost executor cannot take it."""
    rdd.persist().checkpoint()
    rdd.count()
    return rdd


def fit(rows: DataFrame, s: Settings, rows_per_block: int = ROWS_PER_BLOCK) -> Forest:
    """Trees for the logistic loss on (row bigint, x array<double>, label 0/1, weight).

    ``rows`` should be a stored table, numbered by ``row``; NaN in ``x`` is a missing value and takes
    the side that gains more.  Margins start at 0, the best constant under balanced weights.  Rows
    without a label or weight are left out; without any row it raises.
    """
    spark = rows.sparkSession
    use_checkpoints(spark)
    rows = rows.select("row", "x", F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight")).where(
        "label is not null and weight is not null")
    size = rows.agg(F.count("*").alias("n"), F.sum("weight").alias("w")).first()
    if not size.n:
        raise ValueError("no rows to learn from")
    cuts = feature_cuts(rows, s.bins)
    scale = whole_scale(size.w)
    reducers = spark.sparkContext.defaultParallelism
    if size.n <= rows_per_block:
        parts = min(reducers, math.ceil(size.n / DRAW_ROWS))
    else:  # as many blocks as the cores can take in equal turns
        parts = math.ceil(math.ceil(size.n / rows_per_block) / reducers) * reducers
    blocks = stored(packed(rows, cuts, parts))
    entries = blocks.map(lambda block: len(block[1])).sum()
    tasks, folder = _side_by_side(spark, entries, cuts, s)
    forest = _grown_side_by_side(blocks, tasks, folder, cuts, s, scale) if tasks else None
    if forest is not None:
        pass
    elif entries <= rows_per_block:
        forest = _grown_together(blocks, entries, cuts, s, scale)
    else:
        forest = _grown_apart(blocks, cuts, s, scale, reducers)
    blocks.unpersist()
    return forest


def _grown_together(blocks: RDD, entries: int, cuts, s: Settings, scale: float) -> Forest:
    """All entries in one task, many trees a job; the blocks count what the trees draw."""
    forest, widths = Forest.empty(s.trees, s.depth, len(cuts)), widths_of(cuts)
    whole = stored(in_one_task(blocks, lambda block: block[:3]).map(lambda arrays: counted_together(*arrays, widths)))
    state = whole.map(lambda block: (None, np.zeros(len(block[1]))))
    most = max(1, min(TREES_PER_JOB, DRAWN_BYTES // entries))
    for first in range(0, s.trees, most):
        trees, before = range(first, min(first + most, s.trees)), state
        drawn = in_one_task(blocks, lambda block, trees=trees: (np.stack([drawn_counts(*block[3:], s, t) for t in trees]),))
        state = stored(whole.zip(drawn).zip(before).map(lambda found, trees=trees: grow_here(
            found[0][0], found[1][1], found[0][1][0], trees, cuts, s, scale)))
        before.unpersist()
        grown = state.map(lambda pair: pair[0]).collect()[0]
        for c in Forest.COLUMNS:
            getattr(forest, c)[trees.start:trees.stop] = getattr(grown, c)
    state.unpersist()
    whole.unpersist()
    return forest


def sums_of_a_level(cuts, s: Settings) -> int:
    """Most bytes of sums that a task has for a level: those of its lighter children."""
    return 16 * int(widths_of(cuts).sum()) * 2 ** max(0, s.depth - 2)


def _side_by_side(spark: SparkSession, entries: int, cuts, s: Settings) -> tuple[int, str | None]:
    """(tasks, mounted folder) with which trees grow side by side; no tasks where that does not pay or cannot be."""
    tasks = min(tasks_at_once(spark), math.ceil(entries / ENTRIES_A_TASK) * 4)
    if entries <= ENTRIES_A_TASK or tasks < 2 or entries > tasks * ENTRIES_AT_ONCE or tasks * sums_of_a_level(cuts, s) > BYTES_TO_DRIVER:
        return 0, None
    folder = mounted(spark, work_path(spark, "sums"))
    return (tasks, folder) if folder else (0, None)


class Meeting:
    """Sums of tasks that run at the same time, added up through files in a folder that all of them see."""

    def __init__(self, folder: str, me: int, size: int):
        os.makedirs(folder, exist_ok=True)
        self.folder, self.me, self.size, self.step = folder, me, size, 0

    def _file(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def total(self, own: np.ndarray) -> np.ndarray:
        """The sum of what every task gives in this step; whole numbers, so their order changes nothing."""
        mine, until = self._file(self.step, self.me), time.monotonic() + WAIT_SECONDS
        own.tofile(f"{mine}.tmp")
        os.replace(f"{mine}.tmp", mine)
        out = own.copy()
        for task in range(self.size):
            if task == self.me:
                continue
            while not os.path.exists(name := self._file(self.step, task)):
                if time.monotonic() > until:
                    raise TimeoutError(f"no sums of task {task} in step {self.step}")
                time.sleep(LOOK_SECONDS)
            out += np.fromfile(name).reshape(own.shape)
        if self.step:  # who has come here has read all files of the step before
            os.remove(self._file(self.step - 1, self.me))
        self.step += 1
        return out


def dealt_out(block: tuple, tasks: int) -> Iterable[tuple[int, tuple]]:
    """A block's entries dealt to the tasks in turn, so that each has its share of every node."""
    bins, label, weight, row, starts = block
    sizes = np.diff(starts, append=len(row))
    owner = np.repeat(np.arange(len(label)) % tasks, sizes)
    for task in range(min(tasks, len(label))):
        own = sizes[task::tasks]
        yield task, (np.ascontiguousarray(bins[:, task::tasks]), label[task::tasks], weight[task::tasks],
                     row[owner == task], np.cumsum(own) - own)


def _grown_side_by_side(blocks: RDD, tasks: int, folder: str, cuts, s: Settings, scale: float) -> Forest | None:
    """All trees in one barrier stage; a stage that has to start anew begins with the first tree, in another folder.

    None where the session deals out to more partitions than it is asked for, as these need not run at the same time.
    """
    widths = widths_of(cuts)

    def grow(pieces):
        context, pieces = BarrierTaskContext.get(), [piece for _, piece in pieces]
        bins, label, weight, row = (np.concatenate([p[i] for p in pieces], axis=-1) for i in range(4))
        before = np.cumsum([0, *[len(p[3]) for p in pieces]])
        starts = np.concatenate([p[4] + n for p, n in zip(pieces, before)])
        del pieces
        block, trees = counted_together(bins, label, weight, widths), range(s.trees)
        meeting = Meeting(f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}", context.partitionId(), tasks)
        drawn = (drawn_counts(row, starts, s, t) for t in trees)
        forest, _ = grow_here(block, np.zeros(len(label)), drawn, trees, cuts, s, scale, meeting.total)
        return [forest] if context.partitionId() == 0 else []

    pieces = blocks.flatMap(lambda block: dealt_out(block, tasks)).partitionBy(tasks, int)
    if pieces.getNumPartitions() != tasks:
        return None
    return pieces.barrier().mapPartitions(grow).collect()[0]


def _grown_apart(blocks: RDD, cuts, s: Settings, scale: float, reducers: int) -> Forest:
    """A job per level over all blocks."""
    forest, widths = Forest.empty(s.trees, s.depth, len(cuts)), widths_of(cuts)
    state = stored(blocks.map(lambda block: ((*counted_together(*block[:3], widths), *block[3:]), np.zeros(len(block[1])))))

    def moved(pair, tree, value):
        block, margin = pair[0], pair[1].copy()
        add_values(margin, block[0], widths, tree, value, [(0, np.arange(len(margin)))])
        return block, margin

    before = None
    for t in range(s.trees):
        tree = grow_apart(state, forest, t, cuts, s, scale, reducers)
        if before is not None:  # the tree's first job has stored what came of it
            before.unpersist()
        before, value = state, forest.value[t].copy()
        state = state.map(lambda pair, tree=tree, value=value: moved(pair, tree, value)).persist()
        if (t + 1) % CHECKPOINT_TREES == 0:
            state.checkpoint()
    before.unpersist()
    return forest


# --- use ------------------------------------------------------------------------------------------

def margin_column(spark: SparkSession, forest: Forest, x: Column) -> Column:
    """The margin of an array column; the forest, bounded by trees × nodes, is broadcast."""
    shared = spark.sparkContext.broadcast(vars(forest))

    @F.pandas_udf("double")
    def margin(values: pd.Series) -> pd.Series:
        return pd.Series(Forest(**shared.value).margins(np.stack(values.to_numpy())) if len(values) else [], dtype=float)

    return margin(x)


def merged_margins(s: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal margins merged, ascending, with their numbers of positives and negatives."""
    order = np.argsort(s, kind="stable")
    s = s.take(order)
    at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.intp)
    if not len(at):
        return s, pos, neg
    return s.take(at), *[np.add.reduceat(v.take(order), at, dtype=np.int64) for v in (pos, neg)]


def _counts(v: np.ndarray) -> bytes:
    return v.astype(np.uint8 if v.max(initial=0) < 256 else np.int64).tobytes()


def _counted(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else np.int64)


def margin_cuts(rows: DataFrame, forest: Forest, total: int) -> np.ndarray:
    """(cells - 1, trees): margins that part the rows into cells of about ``CELL_MARGINS`` after every tree.

    Quantiles of some rows, which only balance the work.
    """
    cells = math.ceil(total / CELL_MARGINS)
    if cells <= 1:
        return np.empty((0, len(forest)))
    some = rows.select("x").sample(min(1.0, CUT_ROWS / total), seed=0).collect()
    if not some:
        return np.empty((0, len(forest)))
    return np.quantile(np.cumsum(forest.leaves(np.array([r.x for r in some], float)), axis=1), np.arange(1, cells) / cells, axis=0)


def staged_margins(rows: DataFrame, forest: Forest, part: str, label: str, cuts: np.ndarray, times: str | None = None) -> DataFrame:
    """(part, iteration, cell, p, q, s, pos, neg): margins after each tree, equal ones merged, of a batch of rows.

    A row is one batch's margins of a cell as arrays of bytes.  Each row's margin is carried from tree
    to tree; the sum after a tree is the model of that size.  ``times`` names a column that tells how many rows
    a row stands for.
    """
    shared = rows.sparkSession.sparkContext.broadcast((vars(forest), cuts))
    names = ["part", "iteration", "cell", "p", "q", "s", "pos", "neg"]

    def run(batches):
        forest, cuts = Forest(**shared.value[0]), shared.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, which = np.unique(np.array(batch.column("part").to_pylist(), object), return_inverse=True)
            every, times = matrix(batch.column("x")), batch.column("times").to_numpy()
            hits = np.where(batch.column("label").to_numpy(zero_copy_only=False) == 1, times, 0)
            for number, name in enumerate(owner):
                x, hit = every[which == number], hits[which == number]
                miss = times[which == number] - hit
                for first in range(0, len(forest), STAGED_TREES):
                    some = Forest(**{c: getattr(forest, c)[first:first + STAGED_TREES] for c in Forest.COLUMNS}, width=forest.width)
                    added = np.concatenate([some.leaves(x[i:i + 2048]).T for i in range(0, len(x), 2048)], axis=1)
                    margin = added[0] if first == 0 else margin + added[0]
                    found = []
                    for t in range(first, first + len(some)):
                        margin = margin if t == first else margin + added[t - first]
                        s, pos, neg = merged_margins(margin, hit, miss)
                        ends = [0, *np.searchsorted(s, cuts[:, t]), len(s)]
                        for cell, (lo, hi) in enumerate(zip(ends, ends[1:])):
                            if hi > lo:
                                found.append((name, t + 1, cell, int(pos[lo:hi].sum()), int(neg[lo:hi].sum()),
                                              s[lo:hi].tobytes(), _counts(pos[lo:hi]), _counts(neg[lo:hi])))
                    yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(zip(*found), (
                        pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names)

    many = F.col(times) if times else F.lit(1)
    return rows.select(F.col(part).alias("part"), "x", F.col(label).cast("int").alias("label"), many.cast("bigint").alias("times")).mapInArrow(
        run, "part string, iteration int, cell int, p bigint, q bigint, s binary, pos binary, neg binary")


def precision_steps(group: pd.DataFrame) -> pd.DataFrame:
    """What a cell of margins adds to the average precision of its part and tree, times the positives."""
    sizes = [len(v) // 8 for v in group["s"]]
    pos, neg = (np.concatenate([_counted(v, n) for v, n in zip(group[c], sizes)]) for c in ("pos", "neg"))
    _, pos, neg = merged_margins(np.concatenate([np.frombuffer(v) for v in group["s"]]), pos, neg)
    first = group.iloc[0]
    tp, fp = first.p_above + np.cumsum(pos[::-1]), first.q_above + np.cumsum(neg[::-1])
    return pd.DataFrame({"part": [first.part], "iteration": [first.iteration], "positives": [int(pos.sum())],
                         "steps": [float((pos[::-1] * (tp / (tp + fp))).sum())]})


def average_precision_by_tree(rows: DataFrame, forest: Forest, part: str, label: str) -> DataFrame:
    """(part, iteration, average_precision): step-wise and exact after every tree; 0 without positives.

    Margins travel as arrays, one row for a batch, tree and cell; a cell is sorted by itself and shifted
    by the totals of the cells above it.  Rows of one part equal in all features and the label have equal margins
    after every tree, so they go through the trees as one with their number.
    """
    rows = materialise(rows.groupBy(part, "x", label).agg(F.count("*").alias("__times")), "entries")
    total = rows.count()
    rows = fill_cores(rows)
    cuts = margin_cuts(rows, forest, total)
    made, keys = staged_margins(rows, forest, part, label, cuts, "__times"), ["part", "iteration", "cell"]
    if len(cuts):
        made = materialise(made, "margins")
        higher = Window.partitionBy("part", "iteration").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
        above = made.groupBy(*keys).agg(F.sum("p").alias("p"), F.sum("q").alias("q")).select(
            *keys, *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_above") for c in "pq"])
        # A row per part, tree and cell.
        made = made.join(F.broadcast(above), keys)
    else:
        made = made.withColumns({"p_above": F.lit(0).cast("bigint"), "q_above": F.lit(0).cast("bigint")})
    steps = made.drop("p", "q").groupBy(*keys).applyInPandas(
        precision_steps, "part string, iteration int, positives bigint, steps double")
    return steps.groupBy("part", "iteration").agg(F.sum("steps").alias("steps"), F.sum("positives").alias("positives")).select(
        F.col("part").alias(part), "iteration",
        F.when(F.col("positives") > 0, F.col("steps") / F.col("positives")).otherwise(0.0).alias("average_precision"))
