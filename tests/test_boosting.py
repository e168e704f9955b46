import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from cardwarden import fixed
from cardwarden.operators import boosting
from cardwarden.operators.boosting import Settings
from cardwarden.session import materialise

ALL = [Settings(**{"trees": 6, **fixed.BOOSTED}), Settings(**{"trees": 6, **fixed.REGULARISED, "child_weight": 2.0}),
       Settings(trees=5, depth=3, rate=0.3, child_weight=0.5)]


def data(n=200, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 1] = np.round(x[:, 1], 1)
    x[:, 2] = rng.integers(0, 2, n)
    x[rng.random((n, 5)) < 0.15] = np.nan
    x[:, 4] = rng.lognormal(size=n)
    y = (np.nan_to_num(x[:, 0], nan=2.0) + x[:, 4] + rng.normal(size=n) / 2 > 1.5).astype(float)
    return x, y, np.where(y == 1, (1 - y).sum() / y.sum(), 1.0)


def stored_rows(spark, x, y, w):
    return materialise(spark.createDataFrame(pd.DataFrame(
        {"row": np.arange(len(y)), "x": list(x), "label": y, "weight": w})), "rows")


def by_hand(x, y, w, s):
    """Every split tried on every node with plain sums: (rows' margins, splits in order)."""
    n, width = x.shape
    margin, splits = np.zeros(n), []

    def gain_of(g, h):
        return max(abs(g) - s.l1, 0.0) ** 2 / (h + s.l2)

    for t in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        drawn = boosting.mix(np.arange(n), (s.seed + 1) * 1_000_003 + t * 7919) < s.row_share
        columns = boosting.drawn_columns(s, t, width)
        work = [(np.ones(n, bool), 0)]
        while work:
            rows, depth = work.pop()
            use = rows & drawn
            best = (-math.inf,)
            if depth < s.depth:
                for f in columns:
                    v = x[:, f]
                    present = np.unique(v[~np.isnan(x[:, f])])
                    for cut in [*present[1:], math.inf]:
                        for missing_left in (False, True):
                            left = np.where(np.isnan(v), missing_left, v < cut)
                            a, b = use & left, use & ~left
                            if min(h[a].sum(), h[b].sum()) < s.child_weight or not a.any() or not b.any():
                                continue
                            gain = gain_of(g[a].sum(), h[a].sum()) + gain_of(g[b].sum(), h[b].sum()) - gain_of(
                                g[use].sum(), h[use].sum())
                            if gain > best[0] + 1e-9:
                                best = (gain, f, cut, left)
            if best[0] > boosting.LEAST_GAIN and best[0] >= s.least_gain:
                splits.append((t, best[1], best[2]))
                work += [(rows & best[3], depth + 1), (rows & ~best[3], depth + 1)]
            else:
                G, H = g[use].sum(), h[use].sum()
                margin = margin + rows * (-np.sign(G) * max(abs(G) - s.l1, 0.0) / (H + s.l2) * s.rate)
    return margin, splits


@pytest.mark.parametrize("s", ALL)
def test_forest_equals_plain_boosting(spark, s):
    x, y, w = data()
    forest = boosting.fit(stored_rows(spark, x, y, w), s)
    want, splits = by_hand(x, y, w, s)
    assert (forest.feature >= 0).sum() == len(splits) > 5
    assert forest.margins(x) == pytest.approx(want, abs=1e-7)
    found = sorted((t, forest.feature[t, i], forest.cut[t, i]) for t, i in zip(*np.nonzero(forest.feature >= 0)))
    assert [f[:2] for f in found] == [f[:2] for f in sorted(splits)]


def test_blocks_do_not_change_the_forest(spark):
    """Level by level over several blocks or within one: the same trees to the last bit."""
    x, y, w = data(300, seed=9)
    rows, s = stored_rows(spark, x, y, w), Settings(trees=3, depth=4, row_share=0.7, column_share=0.6, l2=2.0, seed=5)
    one = boosting.fit(rows, s)
    for parts in (40, 140):
        other = boosting.fit(rows, s, rows_per_block=parts)
        for c in boosting.Forest.COLUMNS:
            assert np.array_equal(getattr(one, c), getattr(other, c), equal_nan=True), c


def test_equal_rows_are_one_entry(spark, monkeypatch):
    """Copies count as one entry, also across blocks; few entries need no job per level, however many their rows."""
    x, y, w = data(150, seed=6)
    copies = np.r_[np.repeat(np.arange(150), 20), np.full(900, 7)]
    x, y, w = x[copies], y[copies], w[copies]
    rows, s = stored_rows(spark, x, y, w), Settings(trees=3, depth=3, rate=0.3, row_share=0.6, column_share=0.8)
    monkeypatch.setattr(boosting, "DRAWN_BYTES", 500)
    one = boosting.fit(rows, s, rows_per_block=1000)
    assert one.margins(x) == pytest.approx(by_hand(x, y, w, s)[0], abs=1e-7)
    for parts in (1 << 20, 100):
        other = boosting.fit(rows, s, rows_per_block=parts)
        for c in boosting.Forest.COLUMNS:
            assert np.array_equal(getattr(one, c), getattr(other, c), equal_nan=True), c
    monkeypatch.undo()

    def jobs(trees):
        spark.sparkContext.setJobGroup(f"copies {trees}", "")
        boosting.fit(rows, Settings(trees=trees, depth=3), rows_per_block=1000)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"copies {trees}"))
    assert jobs(12) == jobs(2)


def test_draws_are_counted_by_entry():
    starts, row, s = np.array([0, 1, 4, 400]), np.random.default_rng(2).permutation(500), Settings(trees=1, row_share=0.7, seed=3)
    drawn = boosting.drawn_rows(row, s, 5)
    assert np.array_equal(drawn, boosting.mix(row, 4 * 1_000_003 + 5 * 7919) < 0.7)
    counts = boosting.drawn_counts(row, starts, s, 5)
    assert counts.tolist() == [int(part.sum()) for part in np.split(drawn, starts[1:])] and counts[2] > 255
    assert boosting.drawn_counts(row, np.arange(500), s, 5).dtype == np.uint8


def test_missing_values_take_the_side_that_gains(spark):
    v = np.array([0.0, 1, 2, 3, np.nan, np.nan] * 10)
    y = np.array([0.0, 0, 1, 1, 1, 1] * 10)
    forest = boosting.fit(stored_rows(spark, v[:, None], y, np.ones(60)), Settings(trees=1, depth=1, rate=1.0))
    assert forest.feature[0, 0] == 0 and forest.cut[0, 0] == 2.0 and not forest.missing_left[0, 0]
    only = boosting.fit(stored_rows(spark, np.where(np.isnan(v), v, 1.0)[:, None], np.isnan(v) * 1.0, np.ones(60)),
                        Settings(trees=1, depth=1, rate=1.0))
    # One present value: present against missing.
    assert only.cut[0, 0] == math.inf and only.margins(np.array([[1.0], [np.nan]]))[0] < 0 < only.margins(np.array([[np.nan]]))[0]


def test_constant_tables_make_a_bare_root(spark):
    rows = stored_rows(spark, np.full((20, 2), np.nan), np.r_[np.ones(10), np.zeros(10)], np.ones(20))
    forest = boosting.fit(rows, Settings(trees=2))
    assert (forest.feature < 0).all() and forest.margins(np.zeros((1, 2)))[0] == 0 and forest.importance().sum() == 0
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(rows.where("row < 0"), Settings(trees=1))
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(rows.selectExpr("row", "x", "cast(null as double) as label", "weight"), Settings(trees=1))
    with pytest.raises(ValueError, match="out of range"):
        Settings(trees=1, depth=40)


def test_summaries_bound_the_rank_error():
    rng = np.random.default_rng(1)
    v, w = rng.lognormal(size=40_000), rng.random(40_000)
    parts = [boosting.pruned(boosting.summary_of(a, b), 200) for a, b in zip(np.split(v, 40), np.split(w, 40))]
    summary = boosting.pruned(boosting.merged(parts), 200)
    order = np.argsort(v)
    through = np.cumsum(w[order])
    below = through[np.searchsorted(v[order], summary[:, 0], side="left")] - w[order][np.searchsorted(v[order], summary[:, 0])]
    middle = (summary[:, 1] + summary[:, 2]) / 2
    assert len(summary) <= 200
    assert np.abs(middle - below).max() < 3 * w.sum() / 200
    assert (summary[:, 1] <= below + 1e-6).all() and (below <= summary[:, 2] + 1e-6).all()
    few = boosting.merged([boosting.summary_of(np.array([1.0, 2, 2, np.nan]), np.ones(4)), boosting.summary_of(np.array([2.0, 5]), np.ones(2))])
    assert few.tolist() == [[1, 0, 1, 1], [2, 1, 4, 3], [5, 4, 5, 1]]
    assert boosting.cuts_of(few, 256).tolist() == [2, 5] and len(boosting.cuts_of(summary, 64)) <= 62


def test_cuts_over_many_tasks(spark):
    """More tasks than a merge takes at once; few values give one cell each."""
    x = np.column_stack([np.arange(3000) % 7, np.full(3000, np.nan)])
    rows = stored_rows(spark, x, np.zeros(3000), np.ones(3000)).repartition(150)
    cuts = boosting.feature_cuts(rows, 256)
    assert cuts[0].tolist() == [1, 2, 3, 4, 5, 6] and cuts[1].tolist() == []


def test_sums_too_large_for_the_driver_meet_in_reducers(spark, monkeypatch):
    x, y, w = data(300, seed=11)
    rows, s = stored_rows(spark, x, y, w), Settings(trees=2, depth=3, row_share=0.7, column_share=0.6)
    one = boosting.fit(rows, s, rows_per_block=40)
    monkeypatch.setattr(boosting, "BYTES_TO_DRIVER", 0)
    other = boosting.fit(rows, s, rows_per_block=40)
    for c in boosting.Forest.COLUMNS:
        assert np.array_equal(getattr(one, c), getattr(other, c), equal_nan=True), c


def test_columns_of_few_cells_are_counted_together():
    """One count per bundle, and the same sums as a count per column."""
    rng = np.random.default_rng(3)
    widths = np.array([3, 250, 4, 2, 9, 30, 3, 3, 3])
    bins = np.stack([rng.integers(0, w, 5000) for w in widths]).astype(np.uint8)
    bundles = boosting.bundled(bins, widths)
    assert sorted(f for b in bundles for f in b[2]) == list(range(9)) and len(bundles) <= 5
    g, h = rng.integers(-1000, 1000, 5000).astype(float), rng.integers(0, 1000, 5000).astype(float)
    rows, columns = np.flatnonzero(rng.random(5000) < 0.3), np.array([0, 1, 4, 5, 8])
    found = boosting.node_sums(bundles, rows, g, h, columns, widths)
    want = [np.concatenate([np.bincount(bins[f, rows], v[rows], widths[f]) for f in columns]) for v in (g, h)]
    assert np.array_equal(found, want)


def test_two_bundles_are_added_in_one_pass():
    """Nodes of many rows take joint codes, small ones the bundles' own; the sums are the same."""
    rng = np.random.default_rng(4)
    widths = np.array([60, 70, 256, 250, 200])
    bins = np.stack([rng.integers(0, w, 80_000) for w in widths]).astype(np.uint8)
    bundles = boosting.bundled(bins, widths)
    pairs = boosting.paired(bundles)
    assert sorted(i for _, members in pairs for i in members) == list(range(len(bundles)))
    assert sum(joint is not None for joint, _ in pairs) == 2
    gh = rng.integers(-1000, 1000, 80_000) + 1j * rng.integers(0, 1000, 80_000)
    for rows in (np.arange(80_000), np.arange(0, 80_000, 5), np.arange(0, 80_000, 1000)):
        for columns in (np.arange(5), np.array([0, 2, 4])):
            found = boosting.joint_sums(bundles, pairs, rows, gh, columns, widths)
            want = [np.concatenate([np.bincount(bins[f, rows], v[rows], widths[f]) for f in columns]) for v in (gh.real, gh.imag)]
            assert np.array_equal(found, want)


def test_rows_are_drawn_by_whole_numbers():
    """The same rows as by comparing the uniform numbers, shares of one and next to it included."""
    rows = np.arange(50_000)
    for share in (1.0, 1 - 2.0 ** -53, 0.8, 1 / 3, 2.0 ** -53):
        assert np.array_equal(boosting.below_share(rows, 12345, share), boosting.mix(rows, 12345) < share)


def test_a_tree_over_several_blocks_takes_a_job_per_level(spark):
    """And none for its margins, which come with the next tree; 1,000 trees are 6,000 jobs or so."""
    x, y, w = data(300, seed=9)
    rows = stored_rows(spark, x, y, w)

    def jobs(trees):
        spark.sparkContext.setJobGroup(f"fit {trees}", "")
        boosting.fit(rows, Settings(trees=trees, depth=3, child_weight=0.1), rows_per_block=40)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit {trees}"))
    assert jobs(7) - jobs(2) <= 5 * 3


def test_leaves_are_those_of_a_walk_in_little_memory():
    """Trees with leaves at every depth and rows with gaps, a few trees at a time."""
    rng = np.random.default_rng(8)
    trees, depth, width, rows = 400, 6, 5, 500
    forest = boosting.Forest.empty(trees, depth, width)
    inner = 2 ** depth - 1
    forest.feature[:, :inner] = np.where(rng.random((trees, inner)) < 0.8, rng.integers(0, width, (trees, inner)), -1)
    for n in range(1, inner):
        forest.feature[forest.feature[:, (n - 1) // 2] < 0, n] = -1
    forest.cut[:] = rng.normal(size=forest.cut.shape)
    forest.missing_left[:] = rng.random(forest.cut.shape) < 0.5
    forest.value[:] = rng.normal(size=forest.cut.shape)
    x = np.where(rng.random((rows, width)) < 0.2, np.nan, rng.normal(size=(rows, width)))

    def walked(t, row):
        at = 0
        while forest.feature[t, at] >= 0:
            v = row[forest.feature[t, at]]
            at = 2 * at + (1 if (forest.missing_left[t, at] if np.isnan(v) else v < forest.cut[t, at]) else 2)
        return forest.value[t, at]
    tracemalloc.start()
    try:
        got = forest.leaves(x)
        assert tracemalloc.get_traced_memory()[1] < 3 * got.nbytes
    finally:
        tracemalloc.stop()
    assert (got[:40] == [[walked(t, row) for t in range(trees)] for row in x[:40]]).all()
    whole = np.nan_to_num(x)
    assert (forest.leaves(whole)[:40] == [[walked(t, row) for t in range(trees)] for row in whole[:40]]).all()
    assert forest.leaves(x[:0]).shape == (0, trees)


def test_gradients_in_little_memory():
    """The same numbers as over all rows at once; what is worked out on the way is held for some rows."""
    rng = np.random.default_rng(9)
    n, s = 200_000, Settings(trees=1, row_share=0.8)
    margin, label, weight = rng.normal(size=n), rng.integers(0, 2, n) * 1.0, rng.random(n)
    block = (None, np.arange(n), label, weight, None)
    tracemalloc.start()
    try:
        g, h, drawn = boosting.gradients(block, margin, s, 0, 2.0 ** 20)
        assert tracemalloc.get_traced_memory()[1] < 3 * margin.nbytes
    finally:
        tracemalloc.stop()
    p = 1 / (1 + np.exp(-margin))
    assert (g == np.rint(weight * (p - label) * 2.0 ** 20)).all() and (h == np.rint(weight * p * (1 - p) * 2.0 ** 20)).all()
    assert 0.79 < drawn.mean() < 0.81


def test_precision_by_tree_ships_arrays_and_cells_add_up(spark, monkeypatch):
    """A row per batch, tree and cell, not per margin; any number of cells gives the same, ties and empty parts included."""
    x, y, w = data(1500)
    forest = boosting.fit(stored_rows(spark, x, y, w), Settings(trees=12, depth=3, rate=0.3, child_weight=0.5))
    rows = materialise(spark.createDataFrame(pd.DataFrame(
        {"part": np.where(np.arange(1500) % 3 == 0, "a", "b"), "x": list(x), "label": y.astype(int)})).unionByName(
        spark.createDataFrame([("none", [0.0] * 5, 0)] * 3, "part string, x array<double>, label bigint")).repartition(4), "parts")
    margins = np.cumsum(forest.leaves(x), axis=1)

    def wanted(keep, t):
        s, hit = margins[keep, t], y[keep] == 1
        return sum(((hit & (s >= v)).sum() / (s >= v).sum()) for v in s[hit]) / hit.sum()
    for most in (1 << 20, 100):
        monkeypatch.setattr(boosting, "CELL_MARGINS", most)
        cuts = boosting.margin_cuts(rows, forest, 1503)
        assert len(cuts) == (0 if most > 1503 else 15)
        shipped = boosting.staged_margins(rows, forest, "part", "label", cuts)
        assert shipped.count() <= 4 * 3 * 12 * (len(cuts) + 1) and shipped.groupBy().sum("p", "q").first()[0] == 12 * y.sum()
        got = {(r.part, r.iteration): r.average_precision
               for r in boosting.average_precision_by_tree(rows, forest, "part", "label").collect()}
        assert len(got) == 36 and got["none", 3] == 0
        for part, keep in (("a", np.arange(1500) % 3 == 0), ("b", np.arange(1500) % 3 > 0)):
            for t in (0, 4, 11):
                assert got[part, t + 1] == pytest.approx(wanted(keep, t), abs=1e-12)


def test_tasks_side_by_side_grow_the_same_forest(spark, monkeypatch):
    """A few jobs for any number of trees, and the trees of one task and of a job per level to the last bit."""
    x, y, w = data(400, seed=12)
    copies = np.r_[np.arange(400), np.full(90, 3), np.arange(60)]
    x, y, w = x[copies], y[copies], w[copies]
    rows, s = stored_rows(spark, x, y, w), Settings(trees=4, depth=4, row_share=0.7, column_share=0.6, l2=2.0, seed=5)
    one, apart = boosting.fit(rows, s), boosting.fit(rows, s, rows_per_block=80)
    monkeypatch.setattr(boosting, "ENTRIES_A_TASK", 50)
    made = []
    monkeypatch.setattr(boosting, "_grown_side_by_side", lambda *a, grown=boosting._grown_side_by_side: made.append(a) or grown(*a))
    for parts in (1 << 20, 80):
        beside = boosting.fit(rows, s, rows_per_block=parts)
        for other in (one, apart):
            for c in boosting.Forest.COLUMNS:
                assert np.array_equal(getattr(beside, c), getattr(other, c), equal_nan=True), c
    assert len(made) == 2 and made[0][1] > 1

    def jobs(trees):
        spark.sparkContext.setJobGroup(f"beside {trees}", "")
        boosting.fit(rows, Settings(trees=trees, depth=3, child_weight=0.1), rows_per_block=80)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"beside {trees}"))
    assert jobs(9) == jobs(2)
    # A level's sums that are many bytes, or a folder that only Spark reads: as before.
    monkeypatch.setattr(boosting, "mounted", lambda spark, path: None)
    assert boosting._side_by_side(spark, 1000, [np.arange(3)], s) == (0, None)
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "BYTES_TO_DRIVER", 100)
    assert boosting._side_by_side(spark, 1 << 20, [np.arange(3)], s) == (0, None)


def test_entries_are_dealt_out_with_their_rows():
    rng = np.random.default_rng(4)
    starts, row = np.array([0, 1, 4, 9, 10, 12, 20]), rng.permutation(31)
    block = (rng.integers(0, 9, (3, 7)).astype(np.uint8), np.arange(7.0), np.arange(7.0) * 2, row, starts)
    rows_of_entry = np.split(row, starts[1:])
    found = dict(boosting.dealt_out(block, 3))
    assert sorted(found) == [0, 1, 2]
    for task, (bins, label, weight, own, begins) in found.items():
        assert np.array_equal(bins, block[0][:, task::3]) and np.array_equal(weight, 2 * label)
        assert [a.tolist() for a in np.split(own, begins[1:])] == [rows_of_entry[int(e)].tolist() for e in label]
    assert sorted(dict(boosting.dealt_out(block, 9))) == list(range(7))


def test_equal_rows_go_through_the_curve_once(spark, monkeypatch):
    """Copies are one row with their number, beyond 255 too, and every precision is that of all rows."""
    x, y, _ = data(200, seed=13)
    forest = boosting.fit(stored_rows(spark, x, y, np.ones(200)), Settings(trees=5, depth=3, rate=0.3, child_weight=0.5))
    copies = np.r_[np.arange(200), np.repeat(np.arange(60), 5), np.full(400, 9)]
    rows = materialise(spark.createDataFrame(pd.DataFrame(
        {"part": "a", "x": list(x[copies]), "label": y[copies].astype(int)})).repartition(3), "parts")
    seen = []
    monkeypatch.setattr(boosting, "staged_margins", lambda rows, *a, staged=boosting.staged_margins: seen.append(rows.count()) or staged(rows, *a))
    for most in (1 << 20, 50):
        monkeypatch.setattr(boosting, "CELL_MARGINS", most)
        got = {r.iteration: r.average_precision for r in boosting.average_precision_by_tree(rows, forest, "part", "label").collect()}
        margins, hit = np.cumsum(forest.leaves(x[copies]), axis=1), y[copies] == 1
        for t in range(5):
            s = margins[:, t]
            assert got[t + 1] == pytest.approx(sum((hit & (s >= v)).sum() / (s >= v).sum() for v in s[hit]) / hit.sum(), abs=1e-12)
    assert seen == [200, 200]


def test_counts_of_single_rows_are_their_draws():
    row, s = np.random.default_rng(2).permutation(500), Settings(trees=1, row_share=0.7, seed=3)
    counts = boosting.drawn_counts(row, np.arange(500), s, 5)
    assert counts.dtype == np.uint8 and np.array_equal(counts, boosting.drawn_rows(row, s, 5))
    gh = np.arange(500) * (1 + 2j)
    weighed = boosting.weighed(gh.copy(), counts)
    assert np.array_equal(weighed[counts == 1], gh[counts == 1]) and np.array_equal(boosting.weighed(gh.copy(), counts * 3), gh * counts * 3)
