"""Queries over classification and evaluation."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import classify, evaluate, pairs, vectors
from conceptlink.operators.staging import written
from conceptlink.plans.pair_queries import built, built_sql
from conceptlink.plans.registry import query
from conceptlink.plans.twins import hash_below, hash_key, tidy, with_views
from conceptlink.plans.vector_queries import doc_vecs

LONG_TEXT = 2000.0  # threshold on the text length that stands in for a score


def scored(spark, sf_dir):
    return fx.scores(spark, sf_dir)


def predicted(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("predicted", evaluate.predicted_label(F.col("score"), LONG_TEXT))


PRED = {"pred": f"SELECT *, CASE WHEN score >= {LONG_TEXT} THEN 1 ELSE 0 END AS predicted FROM sc"}


@query("H1", with_views("sc", extra=PRED, body="SELECT doc_id, predicted FROM pred"))
def predicted_labels(spark, sf_dir):
    return predicted(spark, sf_dir).select("doc_id", "predicted")


@query("H2", with_views("sc", extra=PRED, body=f"SELECT {tidy('avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM pred"))
def label_accuracy(spark, sf_dir):
    return evaluate.accuracy(predicted(spark, sf_dir)).select(tidy_col(F.col("accuracy")).alias("accuracy"))


CONF = """conf AS (SELECT count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label = 0 AND predicted = 1) AS fp,
  count(*) FILTER (label = 1 AND predicted = 0) AS fn, count(*) FILTER (label = 0 AND predicted = 0) AS tn FROM pred)"""


@query(
    "H3",
    with_views("sc", extra=PRED, body=f"""SELECT tp, fp, fn, tn, {tidy('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, {tidy('CAST(tp AS DOUBLE) / (tp + fn)')} AS recall
      FROM (WITH {CONF} SELECT * FROM conf)"""),
)
def confusion_counts(spark, sf_dir):
    row = evaluate.confusion(predicted(spark, sf_dir))
    return row.select("tp", "fp", "fn", "tn", tidy_col(F.col("precision")).alias("precision"), tidy_col(F.col("recall")).alias("recall"))


@query(
    "H7",
    with_views("sc", extra=PRED, body=f"SELECT {tidy('2.0 * tp / (2 * tp + fp + fn)')} AS f1 FROM (WITH {CONF} SELECT * FROM conf)"),
)
def f1_score(spark, sf_dir):
    return evaluate.confusion(predicted(spark, sf_dir)).select(tidy_col(F.col("f1")).alias("f1"))


RANKED_AUC = """(sum(CASE WHEN label = 1 THEN r ELSE 0 END) - p * (p + 1) / 2.0) / (p * n)"""
AUC = f"""SELECT {{keys}} {RANKED_AUC} AS auroc FROM (
  SELECT *, avg(rn) OVER (PARTITION BY {{part}} score) AS r, count(*) FILTER (label = 1) OVER ({{over}}) AS p, count(*) FILTER (label = 0) OVER ({{over}}) AS n
  FROM (SELECT *, row_number() OVER ({{over}} ORDER BY score) AS rn FROM {{src}})) GROUP BY {{keys}} p, n"""


def auc_sql(src: str, fold: bool = False) -> str:
    return AUC.format(src=src, keys="fold," if fold else "", part="fold," if fold else "", over="PARTITION BY fold" if fold else "")


@query("H4", with_views("sc", extra={"a": auc_sql("sc")}, body=f"SELECT {tidy('auroc')} AS auroc FROM a"))
def area_under_roc(spark, sf_dir):
    curve = evaluate.score_curve(scored(spark, sf_dir))
    return evaluate.auroc(curve).select(tidy_col(F.col("AUROC")).alias("auroc"))


def pr_views(src: str, fold: bool = False) -> dict[str, str]:
    f, part = ("fold,", "PARTITION BY fold") if fold else ("", "")
    return {
        "pt": f"SELECT {f} score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {src} GROUP BY {f} score",
        "cum": f"""SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n
                   FROM pt WINDOW w AS ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
        "pr": f"""SELECT {f} score, tp / (tp + fp) AS prec, tp / p AS rec, p, n,
                    lag(tp / (tp + fp), 1, 1.0) OVER ({part} ORDER BY score DESC) AS prec0, lag(tp / p, 1, 0.0) OVER ({part} ORDER BY score DESC) AS rec0
                  FROM (SELECT {f} score, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(p AS DOUBLE) AS p, CAST(n AS DOUBLE) AS n FROM cum)""",
    }


@query("H5", with_views("sc", extra=pr_views("sc"), body=f"""SELECT {tidy('sum((rec - rec0) * (prec + prec0) / 2)')} AS auprc,
    {tidy('max(p / (p + n))')} AS no_skill FROM pr"""))
def area_under_precision_recall(spark, sf_dir):
    areas = evaluate.auprc(evaluate.score_curve(scored(spark, sf_dir)))
    return areas.select(tidy_col(F.col("AUPRC")).alias("auprc"), tidy_col(F.col("no_skill")).alias("no_skill"))


@query("H5", with_views("sc", extra=pr_views("sc"), body=f"SELECT score AS threshold, {tidy('prec')} AS precision, {tidy('rec')} AS recall FROM pr"))
def precision_recall_curve(spark, sf_dir):
    points = evaluate.precision_recall_points(evaluate.score_curve(scored(spark, sf_dir)))
    return points.select("threshold", tidy_col(F.col("precision")).alias("precision"), tidy_col(F.col("recall")).alias("recall"))


BEST_F = f"""SELECT {tidy('f')} AS fmax, score AS threshold FROM (SELECT score, 2 * prec * rec / (prec + rec) AS f FROM pr WHERE prec + rec > 0)
             ORDER BY f DESC, score LIMIT 1"""


@query("H6", with_views("sc", extra=pr_views("sc"), body=BEST_F))
def best_f_score(spark, sf_dir):
    best = evaluate.fmax(evaluate.score_curve(scored(spark, sf_dir)))
    return best.select(tidy_col(F.col("fmax")).alias("fmax"), "threshold")


FOLDED = {"f": f"SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {hash_key(7, 'doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM sc"}


@query("H8", with_views("sc", extra=FOLDED, body="SELECT doc_id, label, fold FROM f"))
def stratified_folds(spark, sf_dir):
    return evaluate.stratified_folds(scored(spark, sf_dir), 5, ["doc_id"]).select("doc_id", "label", "fold")


def interpolated(folds: str) -> dict[str, str]:
    """Twin of the mean curve by as-of lookup of the bracketing curve points."""
    return {
        "pts2": f"""SELECT fold, CAST(fp AS DOUBLE) / n AS x, CAST(tp AS DOUBLE) / p AS y, tp FROM cum {folds}
                    UNION ALL SELECT DISTINCT fold, 0.0, 0.0, 0 FROM cum {folds}""",
        "grid": "SELECT unnest(range(100)) AS place",
        "lo": """SELECT fold, place, arg_max(x, x * 2 + y) AS x0, arg_max(y, x * 2 + y) AS y0 FROM grid JOIN pts2 ON x <= place / 99.0 + 1e-12
                 GROUP BY fold, place""",
        "hi": """SELECT fold, place, arg_min(x, x * 2 + y) AS x1, arg_min(y, x * 2 + y) AS y1 FROM grid JOIN pts2 ON x > place / 99.0 + 1e-12
                 GROUP BY fold, place""",
        "tpr": """SELECT lo.fold, lo.place, CASE WHEN lo.place = 0 THEN 0.0 WHEN x1 IS NULL THEN 1.0
                    ELSE y0 + (lo.place / 99.0 - x0) / (x1 - x0) * (y1 - y0) END AS tpr
                  FROM lo LEFT JOIN hi ON hi.fold = lo.fold AND hi.place = lo.place""",
    }


MEAN_ROC = f"""SELECT place, {tidy('place / 99.0')} AS fpr, {tidy('avg(tpr)')} AS mean_tpr, {tidy('stddev_pop(tpr)')} AS std_tpr,
  {tidy('greatest(avg(tpr) - stddev_pop(tpr), 0.0)')} AS lower, {tidy('least(avg(tpr) + stddev_pop(tpr), 1.0)')} AS upper, count(*) AS folds
  FROM tpr GROUP BY place"""


@query("H10", with_views("sc", extra={**FOLDED, **pr_views("f", True), **interpolated("")}, body=MEAN_ROC))
def mean_roc_curve(spark, sf_dir):
    folded = evaluate.stratified_folds(scored(spark, sf_dir), 5, ["doc_id"])
    curve = evaluate.score_curve(folded, group_cols=["fold"])
    columns = ["fpr", "mean_tpr", "std_tpr", "lower", "upper"]
    return evaluate.mean_roc(curve).select("place", *[tidy_col(F.col(c)).alias(c) for c in columns], "folds")


@query(
    "H11",
    with_views(
        "sc",
        extra={**PRED, "a": auc_sql("sc"), **pr_views("sc")},
        body=f"""SELECT metric, {tidy('value')} AS value FROM (
          WITH {CONF}, best AS ({BEST_F})
          SELECT 'AUROC' AS metric, auroc AS value FROM a
          UNION ALL SELECT 'AUPRC', sum((rec - rec0) * (prec + prec0) / 2) FROM pr
          UNION ALL SELECT 'precision', CAST(tp AS DOUBLE) / (tp + fp) FROM conf
          UNION ALL SELECT 'recall', CAST(tp AS DOUBLE) / (tp + fn) FROM conf
          UNION ALL SELECT 'accuracy', CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) FROM conf
          UNION ALL SELECT 'f1', 2.0 * tp / (2 * tp + fp + fn) FROM conf
          UNION ALL SELECT 'fmax', fmax FROM best
          UNION ALL SELECT 'fmax_threshold', threshold FROM best)""",
    ),
)
def metric_report(spark, sf_dir):
    return evaluate.report(scored(spark, sf_dir), threshold=LONG_TEXT).select("metric", tidy_col(F.col("value")).alias("value"))


@query(
    "H11",
    with_views(
        "sc",
        extra={**FOLDED, "a": auc_sql("f", True), **pr_views("f", True)},
        body=f"""SELECT fold, {tidy('auroc')} AS auroc, {tidy('auprc')} AS auprc FROM a
                 JOIN (SELECT fold, sum((rec - rec0) * (prec + prec0) / 2) AS auprc FROM pr GROUP BY fold) USING (fold)""",
    ),
)
def metric_report_by_fold(spark, sf_dir):
    folded = evaluate.stratified_folds(scored(spark, sf_dir), 5, ["doc_id"])
    long = evaluate.report(folded, threshold=LONG_TEXT, group_cols=["fold"])
    picked = {m: F.max(F.when(F.col("metric") == m.upper(), F.col("value"))) for m in ("auroc", "auprc")}
    return long.groupBy("fold").agg(*[tidy_col(c).alias(m) for m, c in picked.items()])


def text_features(spark, sf_dir):
    """Simple text statistics against the quality label."""
    docs = fx.table(spark, sf_dir, "documents")
    labels = fx.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    lines = F.size(F.split("text", "\n"))
    stats = docs.select("doc_id", F.ln(F.col("n_chars") + 1.0).alias("chars"), F.ln(lines + 1.0).alias("lines"),
                        (F.length(F.regexp_replace("text", r"\P{L}", "")) / F.greatest(F.length("text"), F.lit(1))).alias("letters"))
    joined = stats.join(labels, "doc_id")
    return VectorAssembler(inputCols=["chars", "lines", "letters"], outputCol="features").transform(joined).select("doc_id", "features", "label")


@query("H9")
def cross_validation_report(spark, sf_dir):
    rows = classify.balanced_weights(text_features(spark, sf_dir))
    learner = classify.logistic(reg=0.01, l1_ratio=1.0, weights="weight")
    held_out = evaluate.cross_validated_scores(rows, learner, 5, ["doc_id"])
    per_fold = evaluate.report(written(held_out), group_cols=["fold"])
    return evaluate.fold_summary(per_fold)


# --- classifiers -----------------------------------------------------------------------


def featured_pairs(spark, sf_dir):
    """Pairs of both splits with their feature vectors."""
    docs = fx.word_lists(spark, sf_dir)
    known = fx.word_vectors(spark, sf_dir)
    vecs = written(doc_vecs(spark, sf_dir))
    rows = pairs.build_pairs(docs, vecs, known, train_size=0.6)
    return classify.as_features(vectors.with_pair_vectors(rows, vecs, known, stage=True))


def split_of(rows, name):
    return rows.filter(F.col("split") == name)


@query("G1, G4, G7")
def network_training_curve(spark, sf_dir):
    rows = featured_pairs(spark, sf_dir)
    _, curve = classify.train_network(split_of(rows, "train"), split_of(rows, "test"), hidden=8, epochs=2, chunk=5)
    return curve


@query("G2, G6, G8")
def forest_report(spark, sf_dir):
    rows = featured_pairs(spark, sf_dir)
    model = classify.random_forest(trees=20, depth=5).fit(split_of(rows, "train"))
    scores = classify.score(model, split_of(rows, "test")).select("label", "score")
    return evaluate.report(written(scores))


@query("G3, G6, G8")
def logistic_report(spark, sf_dir):
    rows = classify.balanced_weights(featured_pairs(spark, sf_dir))
    model = classify.logistic(reg=0.01, weights="weight").fit(split_of(rows, "train"))
    scores = classify.score(model, split_of(rows, "test")).select("label", "score")
    return evaluate.report(written(scores))


VALID = hash_below("md5(concat_ws('|', '53', '0', CAST(doc_id AS VARCHAR), concept))", 0.5)


@query("G5", with_views("uni", "dv", extra=built_sql("testown"), body=f"""SELECT doc_id, concept, label, 0 AS trial,
    CASE WHEN {VALID} THEN 'valid' ELSE 'test' END AS part FROM built WHERE split = 'test'"""))
def validation_and_test_split(spark, sf_dir):
    unseen = split_of(built(spark, sf_dir), "test")
    return classify.validation_split(unseen).select("doc_id", "concept", "label", "trial", "part")
