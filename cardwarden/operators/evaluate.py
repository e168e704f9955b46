"""Evaluation of scores against 0/1 labels: exact, one aggregate per report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.numeric import ratio
from cardwarden.operators.ordering import balanced_splits, bucketed, grid_of


def _reached(score: Column, thresholds: list[float]) -> Column:
    """How many of the ascending thresholds the score reaches (bounds included)."""
    out = F.when(score >= thresholds[-1], len(thresholds))
    for i in range(len(thresholds) - 2, -1, -1):
        out = out.when(score >= thresholds[i], i + 1)
    return out.otherwise(0)


def confusion_by_threshold(df: DataFrame, score: str, label: str,
                           thresholds: list[float] = fixed.SWEEP_THRESHOLDS,
                           by: list[str] = ()) -> DataFrame:
    """Confusion counts at every threshold from one scan.

    Each row falls into one of k+1 cells; the cells are counted per label and the cumulative
    counts are read off those few rows.  Multiplying rows by thresholds would cost k times more.
    """
    thresholds = sorted(thresholds)
    cells = df.groupBy(*by, _reached(F.col(score), thresholds).alias("cell")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    sums = []
    for i in range(len(thresholds)):
        above = F.col("cell") > i
        for name, count, side in (("tp", "pos", above), ("fp", "neg", above),
                                  ("fn", "pos", ~above), ("tn", "neg", ~above)):
            sums.append(F.coalesce(F.sum(F.when(side, F.col(count))), F.lit(0)).alias(f"{name}{i}"))
    rows = F.array(*[
        F.struct(F.lit(t).alias("threshold"),
                 F.col(f"tn{i}").alias("true_negatives"), F.col(f"fp{i}").alias("false_positives"),
                 F.col(f"fn{i}").alias("false_negatives"), F.col(f"tp{i}").alias("true_positives"))
        for i, t in enumerate(thresholds)
    ])
    return cells.groupBy(*by).agg(*sums).select(*by, F.inline(rows))


def with_rates(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and false-positive rate (null without negatives)."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    return confusion.select(
        "*",
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2.0 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(fp, fp + tn, None).alias("false_positive_rate"),
    )


def threshold_sweep(df: DataFrame, score: str, label: str,
                    thresholds: list[float] = fixed.SWEEP_THRESHOLDS, by: list[str] = ()) -> DataFrame:
    return with_rates(confusion_by_threshold(df, score, label, thresholds, by))


def best_threshold(sweep: DataFrame, metric: str, at_least: tuple[str, float] | None = None) -> DataFrame:
    """The row with the highest metric, the lowest threshold among equals, under a constraint.

    No row when the constraint leaves none.
    """
    if at_least is not None:
        sweep = sweep.where(F.col(at_least[0]) >= at_least[1])
    return sweep.orderBy(F.desc(metric), F.asc("threshold")).limit(1)


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """The three operating points: best F1, best precision at recall ≥ 0.5 and the reverse."""
    picks = [
        ("best_f1", best_threshold(sweep, "f1")),
        ("best_precision_at_recall", best_threshold(sweep, "precision", ("recall", 0.5))),
        ("best_recall_at_precision", best_threshold(sweep, "recall", ("precision", 0.5))),
    ]
    out = None
    for name, frame in picks:
        frame = frame.select(F.lit(name).alias("criterion"), "*")
        out = frame if out is None else out.unionByName(frame)
    return out


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC-AUC and step-wise average precision, exact, ties counted as ties.

    Equal scores merge on the map side.  Score groups then go to buckets around approximate
    quantiles, which only balance the work; each bucket is ranked by itself and shifted by the
    totals of the buckets above it (one row per bucket).  AUC is null when a class is absent.
    """
    rows = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y")).where(
        F.col("s").isNotNull() & F.col("y").isNotNull())
    grid = grid_of(rows.count())
    info = rows.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos"),
        F.percentile_approx("s", grid, 4 * (len(grid) + 1)).alias("grid"),
    ).first()
    positives, negatives = info.pos, info.n - info.pos
    grouped = rows.groupBy("s").agg(
        F.sum("y").cast("bigint").alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    splits = balanced_splits(info.n, info.grid)
    cells = bucketed(grouped, "s", splits)
    down = Window.partitionBy("cell").orderBy(F.desc("s")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = cells.select("cell", "pos", "neg", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"))
    if splits:
        from_top = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
        above = cells.groupBy("cell").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).select(
            "cell", F.coalesce(F.sum("p").over(from_top), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("q").over(from_top), F.lit(0)).alias("neg_above"))
        # The offsets are one row per bucket.
        ranked = ranked.join(F.broadcast(above), "cell").select(
            "pos", "neg", (F.col("pos_above") + F.col("tp")).alias("tp"), (F.col("neg_above") + F.col("fp")).alias("fp"))
    # Twice the number of (positive, negative) pairs in right order; ties count one.
    won = F.sum(F.col("pos").cast("decimal(19,0)")
                * (2 * (F.lit(negatives) - F.col("fp")) + F.col("neg")).cast("decimal(19,0)"))
    steps = F.sum(F.when(F.col("pos") > 0, F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))))
    if positives and negatives:
        auc = won.cast("double") / F.lit(2.0 * positives * negatives)
    else:
        auc = F.lit(None).cast("double")
    ap = steps / F.lit(float(positives)) if positives else F.lit(0.0)
    return ranked.agg(
        F.lit(positives).cast("bigint").alias("positives"),
        F.lit(negatives).cast("bigint").alias("negatives"),
        auc.alias("roc_auc"), F.coalesce(ap, F.lit(0.0)).alias("average_precision"),
    )


def ranking_by(df: DataFrame, score: str, label: str, by: str) -> DataFrame:
    """ROC-AUC of every period, exact: equal scores merge before the shuffle, score groups of a period
    are ranked inside balanced buckets and shifted by the period's buckets above."""
    rows = df.select(F.col(by).alias("by"), F.col(score).cast("double").alias("s"), F.col(label).alias("y")).where(
        "s is not null and y is not null")
    grid = grid_of(rows.count())
    info = rows.agg(F.count("*").alias("n"), F.percentile_approx("s", grid, 4 * (len(grid) + 1)).alias("grid")).first()
    grouped = rows.groupBy("by", "s").agg(F.sum("y").cast("bigint").alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    cells = bucketed(grouped, "s", balanced_splits(info.n, info.grid))
    down = Window.partitionBy("by", "cell").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    higher = Window.partitionBy("by").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("by")
    # A row per period and bucket.
    above = cells.groupBy("by", "cell").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).select(
        "by", "cell", F.coalesce(F.sum("q").over(higher), F.lit(0)).alias("neg_above"),
        F.sum("p").over(whole).alias("positives"), F.sum("q").over(whole).alias("negatives"))
    ranked = cells.withColumn("fp", F.sum("neg").over(down)).join(above, ["by", "cell"])
    below = F.col("negatives") - F.col("neg_above") - F.col("fp")
    won = F.sum(F.col("pos").cast("decimal(19,0)") * (2 * below + F.col("neg")).cast("decimal(19,0)")).cast("double")
    pairs = 2.0 * F.col("positives") * F.col("negatives")
    return ranked.groupBy("by", "positives", "negatives").agg(won.alias("won")).select(
        F.col("by").alias(by), "positives", "negatives", F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"))


def classification_report(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Per-class precision, recall, F1 and support, accuracy, macro and weighted means."""
    c = confusion_by_threshold(df, score, label, [threshold])
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    n = tp + fp + fn + tn
    flat = c.select(
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"),
        ratio(2.0 * tn, 2 * tn + fn + fp).alias("f0"), (tn + fp).alias("n0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"),
        ratio(2.0 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("n1"),
        ratio(tp + tn, n).alias("accuracy"), n.alias("n"),
    )

    def mean(x: str) -> Column:
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str) -> Column:
        return ratio(F.col(f"{x}0") * F.col("n0") + F.col(f"{x}1") * F.col("n1"), F.col("n"))

    def row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.alias("support"))

    acc = F.col("accuracy")
    return flat.select(F.inline(F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        row("accuracy", acc, acc, acc, F.col("n")),
        row("macro avg", mean("p"), mean("r"), mean("f"), F.col("n")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("n")),
    )))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """neg/pos for boosted trees and the balanced weights n / (2 n_class)."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives")).select(
        "*",
        ratio(F.col("negatives"), F.col("positives"), None).alias("scale_pos_weight"),
        ratio(F.col("positives") + F.col("negatives"), 2 * F.col("positives"), None).alias("weight_1"),
        ratio(F.col("positives") + F.col("negatives"), 2 * F.col("negatives"), None).alias("weight_0"),
    )


def evaluation_bundle(df: DataFrame, score: str, label: str, name: str, threshold: float = 0.5) -> DataFrame:
    """One row: confusion, rates, ROC-AUC and average precision of a named split."""
    curve = ranking_metrics(df, score, label).first()
    return threshold_sweep(df, score, label, [threshold]).select(
        F.lit(name).alias("split"), "*", F.lit(curve.roc_auc).cast("double").alias("roc_auc"),
        F.lit(curve.average_precision).alias("average_precision"))
