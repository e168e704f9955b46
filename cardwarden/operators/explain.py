"""Why a row got its score: additive attributions and their rankings."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.functions.decision import direction
from cardwarden.operators import boosting
from cardwarden.operators.models import RiskModel
from cardwarden.operators.topk import top_per_group
from cardwarden.session import fill_cores


def _literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def linear_attributions(model: RiskModel, df: DataFrame, background: DataFrame, key: str) -> DataFrame:
    """(key, values, base): coefficient × (value − background mean), in the margin's unit."""
    means = model.features(background).select(Summarizer.mean(F.col("features")).alias("m")).first().m
    coef, intercept = model.classifier.coefficients.toArray(), model.classifier.intercept
    base = float(intercept + coef @ means.toArray())
    x = vector_to_array("features")
    moved = F.zip_with(x, _literal(means), lambda v, m: v - m)
    values = F.zip_with(moved, _literal(coef), lambda v, c: v * c)
    return model.features(df, [key]).select(key, values.alias("values"), F.lit(base).alias("base"))


# --- trees ----------------------------------------------------------------------------------------

def _quadrature(depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on (0, 1) that integrate polynomials of the degree of a path exactly."""
    points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    return (points + 1) / 2, weights / 2


@dataclass(frozen=True)
class _Walk:
    """A tree's nodes level by level, with what a walk needs at each edge into a node.

    ``share`` is the part of the training weight that follows the path where its feature is unknown,
    over all splits on that feature so far; ``prior`` is the last edge above on the same feature.
    """

    parent: list[np.ndarray]
    node: list[np.ndarray]
    prior: np.ndarray
    share: np.ndarray
    feature: np.ndarray


def _walk_of(feature: np.ndarray, cover: np.ndarray) -> _Walk:
    n = len(feature)
    prior, share, on = np.full(n, -1), np.ones(n), np.full(n, -1)
    above: dict[int, dict[int, int]] = {0: {}}
    parents, levels, level = [], [], [0]
    while level:
        down = [c for p in level if feature[p] >= 0 for c in (2 * p + 1, 2 * p + 2)]
        for c in down:
            p = (c - 1) // 2
            f = on[c] = feature[p]
            prior[c] = above[p].get(f, -1)
            share[c] = cover[c] / cover[p] * (share[prior[c]] if prior[c] >= 0 else 1.0)
            above[c] = {**above[p], f: c}
        if down:
            levels.append(np.array(down))
            parents.append((levels[-1] - 1) // 2)
        level = down
    return _Walk(parents, levels, prior, share, on)


def _tree_values(x: np.ndarray, forest: boosting.Forest, t: int, walk: _Walk) -> np.ndarray:
    """Shapley values of one tree for a batch: one walk down and one up, nodes × depth / 2 steps a row.

    A leaf's game is a product over its path's features, of 1 if the row follows the path and of the
    feature's share if it is unknown.  Its Shapley value for a feature is the integral over u in
    (0, 1) of the product of the other features' mixtures, a polynomial of the path's length, so a
    few points give it exactly.  The walk down carries the product at those points; where a feature
    returns, its earlier factor is divided out.  The walk up adds the leaves below every edge.
    """
    points, weights = _quadrature(forest.depth)
    rows, n = len(x), forest.feature.shape[1]
    follows = np.ones((n, rows), bool)
    factor = np.ones((n, rows, len(points)))
    product = np.ones((n, rows, len(points)))
    for parent, node in zip(walk.parent, walk.node):
        v = x[:, walk.feature[node]].T
        left = np.where(np.isnan(v), forest.missing_left[t, parent, None], v < forest.cut[t, parent, None])
        inside = left == (node % 2 == 1)[:, None]
        before = walk.prior[node]
        follows[node] = inside & (follows[before] | (before < 0)[:, None])
        share = walk.share[node][:, None, None]
        factor[node] = share + points * (follows[node][:, :, None] - share)
        old = np.where((before >= 0)[:, None, None], factor[before], 1.0)
        product[node] = product[parent] * factor[node] / old
    values = np.zeros((rows, x.shape[1]))
    below = product * forest.value[t][:, None, None]  # the value of inner nodes is 0
    for parent, node in zip(walk.parent[::-1], walk.node[::-1]):
        sums = below[node] * weights
        own = (follows[node] - walk.share[node][:, None]) * (sums / factor[node]).sum(axis=2)
        before = walk.prior[node]
        again = before >= 0
        if again.any():
            # Leaves below count for the last edge of the feature, not for the one before.
            up = before[again]
            own[again] -= (follows[up] - walk.share[up][:, None]) * (sums[again] / factor[up]).sum(axis=2)
        hot = np.zeros((len(node), x.shape[1]))
        hot[np.arange(len(node)), walk.feature[node]] = 1.0
        values += own.T @ hot
        below[parent[::2]] = below[node[::2]] + below[node[1::2]]
    return values


def _path_tables(forest: boosting.Forest, t: int) -> tuple[list[int], list[tuple]]:
    """A tree's upper splits, and the subtrees of ``SUBTREE_DEPTH`` levels below them with their leaves' values.

    A subtree is (root, its splits, features on its leaves' paths, table): the table has a row per feature and a
    column per combination of sides, left being 1, at the splits on the way to the root and inside, the first one
    the highest bit.  A leaf's values depend only on which of its path's features the row follows.
    """
    points, weights = _quadrature(forest.depth)
    top = 2 ** max(0, forest.depth - SUBTREE_DEPTH) - 1
    upper, inner, leaves, open_nodes = [], {}, {}, [(0, (), (), ())]
    for node, way, features, shares in open_nodes:  # level by level
        root = node
        while root > 2 * top:
            root = (root - 1) // 2
        f = int(forest.feature[t, node])
        if f < 0:
            leaves.setdefault(len(features), []).append((node, root, way, features, shares))
            continue
        if node < top:
            upper.append(node)
        else:
            inner.setdefault(root, []).append(node)
        bit = features.index(f) if f in features else len(features)
        for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
            part = forest.cover[t, child] / forest.cover[t, node]
            open_nodes.append((child, (*way, (node, left, bit)), (*features, f), (*shares, part)) if bit == len(features) else (
                child, (*way, (node, left, bit)), features, (*shares[:bit], shares[bit] * part, *shares[bit + 1:])))
    groups: dict[int, dict[int, np.ndarray]] = {}
    sides: dict[int, dict[int, np.ndarray]] = {}  # root -> split -> for every combination whether its side is the left one
    for k, some in leaves.items():
        if not k:
            continue
        share = np.array([leaf[4] for leaf in some])[:, None]
        moved = (np.arange(2 ** k)[:, None] >> np.arange(k) & 1) - share
        factor = share + points[:, None, None, None] * moved
        others = np.tensordot(weights, factor.prod(axis=3, keepdims=True) / factor, 1)
        values = moved * others * forest.value[t, [leaf[0] for leaf in some]][:, None, None]
        for (_, root, way, features, _), own in zip(some, values):
            if root not in sides:
                splits = [*[node for node, _, _ in way if node < top], *inner.get(root, ())]
                every = np.arange(2 ** len(splits))
                sides[root] = {node: (every >> i & 1).astype(bool) for i, node in enumerate(splits[::-1])}
            follows: dict[int, np.ndarray] = {}
            for node, left, bit in way:
                side = sides[root][node] if left else ~sides[root][node]
                follows[bit] = follows[bit] & side if bit in follows else side
            code = sum(follows[bit].astype(np.intp) << bit for bit in range(k))
            held = groups.setdefault(root, {})
            for f, column in zip(features, np.ascontiguousarray(own.T)):
                held[f] = held[f] + column.take(code) if f in held else column.take(code)
    return upper, [(root, inner.get(root, []), list(held), np.array(list(held.values()))) for root, held in groups.items()]


def _looked_up(x: np.ndarray, forest: boosting.Forest, t: int, upper: list[int], groups: list[tuple]) -> np.ndarray:
    """Shapley values of one tree for a batch: a row's sides at the splits pick a column of each subtree's table."""
    values = np.zeros(x.shape[::-1])
    add_looked_up(values, np.ascontiguousarray(x.T), np.isnan(x).any(axis=0), forest, t, upper, groups)
    return values.T


def add_looked_up(values: np.ndarray, x: np.ndarray, gaps: np.ndarray, forest: boosting.Forest, t: int,
                  upper: list[int], groups: list[tuple]) -> None:
    """One tree's values added to (features, rows); ``gaps`` tells which features have missing values."""
    def turned(code, node):
        f = forest.feature[t, node]
        left = x[f] < forest.cut[t, node]
        if gaps[f] and forest.missing_left[t, node]:
            left |= np.isnan(x[f])
        return code << np.uint16(1) | left

    codes = {0: np.zeros(x.shape[1], np.uint16)}
    for node in upper:
        codes[2 * node + 1] = codes[2 * node + 2] = turned(codes.pop(node), node)
    for root, inner, features, table in groups:
        code = codes[root]
        for node in inner:
            code = turned(code, node)
        code = code.astype(np.intp)
        for f, column in zip(features, table):
            values[f] += column.take(code, mode="clip")


def expected_margin(forest: boosting.Forest) -> float:
    """The mean margin over the training weight: leaf values by their share of the cover."""
    whole = forest.cover[:, :1]
    share = np.divide(forest.cover, whole, out=np.zeros_like(forest.cover), where=whole > 0)
    return float((share * np.where(forest.feature < 0, forest.value, 0.0)).sum())


ROWS_AT_ONCE = 256
# Trees this deep at most have their leaves' values looked up: 8 subtrees with 1,024 combinations of sides each.
LOOKED_UP_DEPTH = 6
SUBTREE_DEPTH = 3
# Rows that go down a tree together, and numbers of rows for which a tree's tables are made once.
LOOKED_UP_ROWS, VALUES_AT_ONCE = 8192, 1 << 21


def _gathered(batches, rows: int):
    """Batches put together until they have so many rows; empty ones are left out."""
    held, size = [], 0
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
            size += len(pdf)
        if size >= rows and held:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def tree_attributions(model: RiskModel, df: DataFrame, key: str) -> DataFrame:
    """(key, values, base) of boosted trees, in the margin's unit; values + base add up to it.

    Exact Shapley values of the path-dependent kind.  Rows stay where they are; the forest, bounded
    by trees × nodes, is broadcast.  A tree costs a look-up per leaf and row, a deep one nodes × depth.
    """
    spark = df.sparkSession
    base = expected_margin(model.forest)
    shared = spark.sparkContext.broadcast(vars(model.forest))
    rows = fill_cores(model.features(df, [key]).select(key, vector_to_array("features").alias("x")))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        forest = boosting.Forest(**shared.value)
        if forest.depth <= LOOKED_UP_DEPTH:
            for pdf in _gathered(batches, VALUES_AT_ONCE // forest.width):
                x = np.stack(pdf["x"].to_numpy()).T
                chunks = [np.ascontiguousarray(x[:, i:i + LOOKED_UP_ROWS]) for i in range(0, x.shape[1], LOOKED_UP_ROWS)]
                gaps, values = np.isnan(x).any(axis=1), [np.zeros(c.shape) for c in chunks]
                for t in range(len(forest)):
                    tables = _path_tables(forest, t)
                    for chunk, own in zip(chunks, values):
                        add_looked_up(own, chunk, gaps, forest, t, *tables)
                yield pd.DataFrame({key: pdf[key], "values": list(np.concatenate(values, axis=1).T.copy()), "base": base})
            return
        walks = [_walk_of(f, c) for f, c in zip(forest.feature, forest.cover)]
        for pdf in batches:
            for i in range(0, len(pdf), ROWS_AT_ONCE):
                part = pdf.iloc[i:i + ROWS_AT_ONCE]
                x = np.stack(part["x"].to_numpy())
                values = np.zeros(x.shape)
                for t, walk in enumerate(walks):
                    values += _tree_values(x, forest, t, walk)
                yield pd.DataFrame({key: part[key], "values": list(values), "base": base})

    return rows.mapInPandas(run, f"`{key}` {kind}, values array<double>, base double")


# --- rankings -------------------------------------------------------------------------------------

def long_attributions(values: DataFrame, names: list[str], key: str) -> DataFrame:
    """(key, feature, value, abs_value, direction), one row per key and feature."""
    pairs = F.zip_with(F.array(*[F.lit(n) for n in names]), "values",
                       lambda f, v: F.struct(f.alias("feature"), v.alias("value")))
    long = values.select(key, F.inline(pairs))
    return long.select(key, "feature", "value", F.abs("value").alias("abs_value"),
                       direction(F.col("value")).alias("direction"))


def save_attributions(values: DataFrame, names: list[str], path: str) -> None:
    """Attributions, feature names and base as one artifact below ``path``; the names come last and complete it.

    Rows keep their array, so the artifact is as narrow as its keys and numbers.
    """
    values.write.mode("overwrite").parquet(f"{path}/values")
    values.sparkSession.createDataFrame(list(enumerate(names)), "position int, feature string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/names")


def load_attributions(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(key, values, base) and the names of a saved artifact; a number of names that does not fit raises."""
    names = [r.feature for r in spark.read.parquet(f"{path}/names").orderBy("position").collect()]
    values = spark.read.parquet(f"{path}/values")
    wrong = values.where(F.size("values") != len(names)).limit(1).count()
    if wrong:
        raise ValueError("attributions and feature names differ in number")
    return values, names


def global_ranking(long: DataFrame, n: int | None = 20) -> DataFrame:
    """Mean |attribution| of every feature, largest first."""
    ranked = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    return ranked.orderBy(F.desc("mean_abs"), "feature").limit(n) if n else ranked


def top_contributors(long: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Per key the n strongest contributors overall, toward and away: (key, list, rank, …).

    Each row enters the overall list and the list of its sign; one ranking serves all three, and
    its rank limit is applied on the map side.
    """
    sign = F.when(F.col("value") > 0, "positive").when(F.col("value") < 0, "negative")
    lists = long.withColumn("list", F.explode(F.array_compact(F.array(F.lit("overall"), sign))))
    return top_per_group(lists, [key, "list"], [F.desc("abs_value"), F.asc("feature")], n)
