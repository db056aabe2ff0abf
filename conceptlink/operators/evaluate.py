"""Scoring of binary predictions: ``(label 0/1, score)`` rows, optionally by group.

Curves are built from counts per distinct score, so a score that repeats on
any share of the rows is one curve point, and running counts are taken over
ordered slices rather than in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.operators.ranking import hash_rank, running_totals
from conceptlink.operators.staging import written

GRID = 99  # the mean curve has GRID + 1 points


def predicted_label(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score >= threshold, 1).otherwise(0)


def accuracy(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def _confusion_columns(label: str, predicted: str) -> list[Column]:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    ]


def confusion(
    df: DataFrame, label: str = "label", predicted: str = "predicted", group_cols: Sequence[str] = ()
) -> DataFrame:
    """Counts, precision, recall, accuracy and F1; null where a ratio has no base."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = df.groupBy(*group_cols).agg(*_confusion_columns(label, predicted))

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole)

    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def score_curve(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, from high to low.

    ``pos``/``neg`` count the rows with that score, ``tp``/``fp`` those with
    that score or a higher one, ``all_pos``/``all_neg`` the whole group.
    """
    keys = list(group_cols) or ["_all"]
    if not group_cols:
        df = df.withColumn("_all", F.lit(1))
    y = F.col(label) == 1
    points = df.groupBy(*keys, F.col(score).alias("score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    curve = written(running_totals(points, [F.desc("score")], {"pos": "tp", "neg": "fp"}, keys))
    totals = curve.groupBy(*keys).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return curve.join(totals, keys).drop(*([] if group_cols else ["_all"]))


def _before(total: str, part: str) -> Column:
    return F.col(total) - F.col(part)


def _area_under_roc() -> Column:
    # rectangles plus half of the ties; a single class has no curve
    area = F.sum(F.col("neg") * (_before("tp", "pos") + F.col("pos") / 2.0))
    base = F.first("all_pos") * F.first("all_neg")
    return F.when(base > 0, area / base)


def _precision(tp: Column, fp: Column) -> Column:
    # the curve ends at recall 0 with precision 1
    return F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)


def _area_under_pr() -> Column:
    here = _precision(F.col("tp"), F.col("fp"))
    before = _precision(_before("tp", "pos"), _before("fp", "neg"))
    area = F.sum(F.col("pos") * (here + before) / 2.0)
    return F.when(F.first("all_pos") > 0, area / F.first("all_pos"))


def _best_f(beta: float) -> Column:
    """Highest F-beta and its score; the lowest score wins a tie."""
    p = _precision(F.col("tp"), F.col("fp"))
    r = F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos"))
    f = F.when(p + r > 0, (1 + beta * beta) * p * r / (beta * beta * p + r))
    return F.max(F.when(f.isNotNull(), F.struct(f.alias("f"), (-F.col("score")).alias("low"))))


def auroc(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*group_cols).agg(_area_under_roc().alias("AUROC"))


def auprc(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, with the no-skill rate."""
    base = F.first("all_pos") / (F.first("all_pos") + F.first("all_neg"))
    return curve.groupBy(*group_cols).agg(_area_under_pr().alias("AUPRC"), base.alias("no_skill"))


def precision_recall_points(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    recall = F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos"))
    return curve.select(*group_cols, F.col("score").alias("threshold"), _precision(F.col("tp"), F.col("fp")).alias("precision"), recall.alias("recall"))


def fmax(curve: DataFrame, beta: float = 1.0, group_cols: Sequence[str] = ()) -> DataFrame:
    """Highest F-beta over all thresholds, and the threshold."""
    best = curve.groupBy(*group_cols).agg(_best_f(beta).alias("best"))
    return best.select(
        *group_cols,
        F.coalesce("best.f", F.lit(0.0)).alias("fmax"),
        F.coalesce(-F.col("best.low"), F.lit(1.0)).alias("threshold"),
    )


def roc_points(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return curve.select(
        *group_cols,
        F.col("score").alias("threshold"),
        (F.col("fp") / F.col("all_neg")).alias("fpr"),
        (F.col("tp") / F.col("all_pos")).alias("tpr"),
    )


def mean_roc(curve: DataFrame, fold: str = "fold", odd_only: bool = False) -> DataFrame:
    """Mean ROC over folds on an even grid: ``(place, fpr, mean_tpr, std_tpr, lower, upper, folds)``.

    Every flat stretch of a curve knows its own start, so it fills the grid
    points it spans and no join against the grid is needed. All folds count,
    or with ``odd_only`` those of odd number.
    """
    if odd_only:
        curve = curve.filter(F.col(fold) % 2 == 1)
    curve = curve.filter("all_pos > 0 and all_neg > 0")
    before_fp, before_tp = _before("fp", "neg"), _before("tp", "pos")
    first = F.ceil(before_fp * GRID / F.col("all_neg"))
    last = F.ceil(F.col("fp") * GRID / F.col("all_neg")) - 1
    spans = curve.filter("neg > 0").withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    rows = spans.withColumn("place", F.explode(F.sequence("_first", "_last")))
    along = (F.col("place") / float(GRID) - before_fp / F.col("all_neg")) / (F.col("neg") / F.col("all_neg"))
    tpr = before_tp / F.col("all_pos") + along * F.col("pos") / F.col("all_pos")
    inner = rows.select(fold, "place", F.when(F.col("place") == 0, 0.0).otherwise(tpr).alias("tpr"))
    ends = curve.select(fold).distinct().select(fold, F.lit(GRID).cast("long").alias("place"), F.lit(1.0).alias("tpr"))
    mean, std = F.avg("tpr"), F.stddev_pop("tpr")
    return (
        inner.unionByName(ends)
        .groupBy("place")
        .agg(
            mean.alias("mean_tpr"),
            std.alias("std_tpr"),
            F.greatest(mean - std, F.lit(0.0)).alias("lower"),
            F.least(mean + std, F.lit(1.0)).alias("upper"),
            F.count(F.lit(1)).alias("folds"),
        )
        .withColumn("fpr", F.col("place") / float(GRID))
    )


def stratified_folds(df: DataFrame, k: int, id_cols: Sequence[str], label: str = "label", seed: int = 7) -> DataFrame:
    """Add ``fold`` in 0..k-1, shuffled within each label."""
    ranked = hash_rank(df, id_cols, seed, [label])
    return ranked.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


def report(
    df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()
) -> DataFrame:
    """AUROC, AUPRC, precision, recall, accuracy, F1 and Fmax as ``(group..., metric, value)`` rows."""
    keys = list(group_cols) or ["_all"]
    if not group_cols:
        df = df.withColumn("_all", F.lit(1))
    curve = score_curve(df, label, score, keys)
    areas = curve.groupBy(*keys).agg(
        _area_under_roc().alias("AUROC"), _area_under_pr().alias("AUPRC"), _best_f(1.0).alias("_best")
    )
    # the confusion counts are sums of curve points, so the rows are not read again
    hit = F.col("score") >= threshold
    counts = curve.groupBy(*keys).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    wide = areas.join(counts, keys).select(
        *keys,
        "AUROC",
        "AUPRC",
        F.when(tp + fp > 0, tp / (tp + fp)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).alias("recall"),
        ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).alias("f1"),
        F.coalesce(F.col("_best.f"), F.lit(0.0)).alias("fmax"),
        F.coalesce(-F.col("_best.low"), F.lit(1.0)).alias("fmax_threshold"),
    )
    names = [c for c in wide.columns if c not in keys]
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
    long = wide.select(*keys, F.explode(cells).alias("m"))
    return long.select(*group_cols, "m.metric", "m.value")


def cross_validated_scores(
    df: DataFrame,
    estimator: Estimator,
    k: int = 5,
    id_cols: Sequence[str] = ("id",),
    label: str = "label",
    seed: int = 53,
) -> DataFrame:
    """``(fold, id..., label, score)``: every row scored by a model that has not seen it."""
    folded = written(stratified_folds(df, k, id_cols, label, seed))
    scored = None
    for fold in range(k):
        model = estimator.fit(folded.filter(F.col("fold") != fold))
        held_out = model.transform(folded.filter(F.col("fold") == fold))
        part = held_out.select("fold", *id_cols, label, vector_to_array("probability")[1].alias("score"))
        scored = part if scored is None else scored.unionByName(part)
    return scored


def fold_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    return per_fold.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


