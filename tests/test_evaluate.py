import numpy as np
import pytest

from cardwarden import fixed
from cardwarden.operators import evaluate, ordering


def scored(spark, rows):
    return spark.createDataFrame([(float(s), int(y)) for s, y in rows], "p double, y int")


def test_rates_of_published_counts(spark):
    # published confusion counts of a test split at threshold 0.60
    row = evaluate.with_rates(spark.createDataFrame(
        [(0.60, 84352, 1146, 1670, 1413)], "threshold double, true_negatives bigint, false_positives bigint, "
        "false_negatives bigint, true_positives bigint")).first()
    assert (round(row.precision, 4), round(row.recall, 4), round(row.f1, 4)) == (0.5522, 0.4583, 0.5009)
    assert round(row.false_positive_rate * 100, 4) == 1.3404


def test_threshold_bound_counts_as_flagged_and_zero_division(spark):
    df = scored(spark, [(0.6, 1), (0.59, 1), (0.1, 0)])
    rows = {r.threshold: r for r in evaluate.threshold_sweep(df, "p", "y", [0.6, 0.9]).collect()}
    assert (rows[0.6].true_positives, rows[0.6].false_negatives) == (1, 1)
    assert (rows[0.9].precision, rows[0.9].recall, rows[0.9].f1) == (0.0, 0.0, 0.0)
    only_positives = evaluate.threshold_sweep(scored(spark, [(0.9, 1)]), "p", "y", [0.5]).first()
    assert only_positives.false_positive_rate is None


def test_sweep_has_seventeen_thresholds(spark):
    assert fixed.SWEEP_THRESHOLDS[0] == 0.10 and fixed.SWEEP_THRESHOLDS[-1] == 0.90
    assert evaluate.threshold_sweep(scored(spark, [(0.5, 1)]), "p", "y").count() == 17


def test_best_thresholds_first_wins_and_constraint_may_leave_nothing(spark):
    sweep = evaluate.threshold_sweep(scored(spark, [(0.9, 1), (0.2, 0)]), "p", "y")
    assert evaluate.best_threshold(sweep, "f1").first().threshold == 0.25
    hopeless = evaluate.threshold_sweep(scored(spark, [(0.05, 1), (0.95, 0)]), "p", "y")
    names = {r.criterion for r in evaluate.best_thresholds(hopeless).collect()}
    assert names == {"best_f1"}


def test_small_hand_values(spark):
    m = evaluate.ranking_metrics(scored(spark, [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)]), "p", "y").first()
    assert m.roc_auc == 0.75 and m.average_precision == pytest.approx(5 / 6)


@pytest.mark.parametrize("rows_per_split", [50_000, 40])
def test_ranking_equals_brute_force(spark, monkeypatch, rows_per_split):
    monkeypatch.setattr(ordering, "ROWS_PER_SPLIT", rows_per_split)
    rng = np.random.default_rng(5)
    p = np.round(rng.beta(1, 8, 1500), 3)
    p[::3] = 0.007  # a third of all rows share one score
    y = (rng.random(1500) < 0.1 + p / 2).astype(int)
    got = evaluate.ranking_metrics(scored(spark, zip(p, y)), "p", "y").first()
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        ap += ((p == s) & (y == 1)).sum() / len(pos) * (y[p >= s].sum() / (p >= s).sum())
    assert got.roc_auc == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)
    assert got.average_precision == pytest.approx(ap, abs=1e-12)


def test_one_class_only(spark):
    m = evaluate.ranking_metrics(scored(spark, [(0.3, 0), (0.4, 0)]), "p", "y").first()
    assert m.roc_auc is None and m.average_precision == 0.0


def test_report_and_weights(spark):
    df = scored(spark, [(0.9, 1), (0.8, 0), (0.2, 0), (0.1, 1), (0.3, 0)])
    report = {r["class"]: r for r in evaluate.classification_report(df, "p", "y").collect()}
    assert report["1"].precision == 0.5 and report["1"].support == 2 and report["accuracy"].f1 == 0.6
    w = evaluate.class_weights(df, "y").first()
    assert (w.scale_pos_weight, w.weight_1, w.weight_0) == (1.5, 1.25, pytest.approx(5 / 6))
