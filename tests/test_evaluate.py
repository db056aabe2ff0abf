import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conceptlink.operators import classify, evaluate


def scored(spark, rows):
    return spark.createDataFrame([(int(y), float(s)) for y, s in rows], "label int, score double").repartition(3)


def values(report):
    return {r["metric"]: r["value"] for r in report.collect()}


def test_perfect_inverted_and_tied(spark):
    perfect = values(evaluate.report(scored(spark, [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)])))
    assert perfect["AUROC"] == perfect["AUPRC"] == perfect["fmax"] == perfect["accuracy"] == 1.0
    assert perfect["fmax_threshold"] == 0.8
    inverted = values(evaluate.report(scored(spark, [(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)])))
    assert inverted["AUROC"] == 0.0 and inverted["precision"] == 0.0
    tied = values(evaluate.report(scored(spark, [(0, 0.5), (1, 0.5), (1, 0.5), (0, 0.5)])))
    assert tied["AUROC"] == 0.5
    assert tied["AUPRC"] == pytest.approx(0.75)


def test_one_class_only(spark):
    got = values(evaluate.report(scored(spark, [(1, 0.4), (1, 0.3)])))
    assert got["AUROC"] is None and got["precision"] is None and got["recall"] == 0.0
    none = values(evaluate.report(scored(spark, [(0, 0.4), (0, 0.6)])))
    assert none["AUPRC"] is None and none["recall"] is None and none["precision"] == 0.0


def test_against_definitions_on_random_scores(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.normal(size=300) + y, 1)
    got = values(evaluate.report(scored(spark, zip(y, s)), threshold=0.5))
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert got["AUROC"] == pytest.approx(wins / (len(pos) * len(neg)))
    best = []
    for t in sorted(set(s)):
        p, r = y[s >= t].mean(), (s[y == 1] >= t).mean()
        best.append((2 * p * r / (p + r) if p + r else 0, -t))
    assert got["fmax"] == pytest.approx(max(best)[0])
    assert got["fmax_threshold"] == pytest.approx(-max(best)[1])
    hit = s >= 0.5
    assert got["accuracy"] == pytest.approx((hit == y).mean())
    assert got["f1"] == pytest.approx(2 * (hit & (y == 1)).sum() / (hit.sum() + y.sum()))


def test_f_tie_takes_the_lowest_threshold(spark):
    # thresholds 0.9 and 0.1 both reach F = 2/3
    best = evaluate.fmax(evaluate.score_curve(scored(spark, [(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.1)]))).first()
    assert best["fmax"] == pytest.approx(2 / 3) and best["threshold"] == 0.1


def test_folds_are_stratified(spark):
    df = spark.range(103).withColumn("label", (F.col("id") < 20).cast("int"))
    rows = evaluate.stratified_folds(df, 5, ["id"]).groupBy("fold", "label").count().collect()
    assert sorted(r["count"] for r in rows if r["label"] == 1) == [4] * 5
    assert sorted(r["count"] for r in rows if r["label"] == 0) == [16, 16, 17, 17, 17]


@pytest.mark.parametrize("n_folds,odd_only", [(3, False), (10, False), (7, True)])
def test_mean_roc_matches_interpolation(spark, n_folds, odd_only):
    rng = np.random.default_rng(2)
    rows, want = [], []
    for fold in range(n_folds):
        y = rng.integers(0, 2, 80)
        s = np.round(rng.normal(size=80) + y, 1)
        rows += [(fold, int(a), float(b)) for a, b in zip(y, s)]
        order = sorted(set(s), reverse=True)
        fpr = [0.0] + [(s[y == 0] >= t).mean() for t in order]
        tpr = [0.0] + [(s[y == 1] >= t).mean() for t in order]
        if not odd_only or fold % 2 == 1:
            line = np.interp(np.linspace(0, 1, 100), fpr, tpr)
            line[0] = 0.0
            want.append(line)
    df = spark.createDataFrame(rows, "fold int, label int, score double")
    curve = evaluate.score_curve(df, group_cols=["fold"])
    got = evaluate.mean_roc(curve, odd_only=odd_only).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(100))
    mean = np.mean(want, axis=0)
    mean[-1] = 1.0
    assert np.allclose([r["mean_tpr"] for r in got], mean, atol=1e-9)
    assert np.allclose([r["std_tpr"] for r in got], np.std(want, axis=0), atol=1e-9)
    assert all(0 <= r["lower"] <= r["upper"] <= 1 for r in got)


def separable(spark, n=400, shuffle=False):
    rows = []
    rng = np.random.default_rng(4)
    labels = np.arange(n) % 2
    centre = labels * 2.0 - 1.0
    if shuffle:
        labels = rng.permutation(labels)
    for i in range(n):
        rows.append((i, int(labels[i]), float(centre[i] + rng.normal() * 0.4), float(-centre[i] + rng.normal() * 0.4)))
    df = spark.createDataFrame(rows, "id long, label int, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@pytest.mark.parametrize("name", ["forest", "logistic"])
def test_classical_models_learn(spark, name):
    df = classify.balanced_weights(separable(spark))
    learner = classify.random_forest(20, 4, 5) if name == "forest" else classify.logistic(0.01, 0.5, "weight")
    held_out = evaluate.cross_validated_scores(df, learner, 2).persist()
    assert held_out.count() == 400
    per_fold = evaluate.report(held_out, group_cols=["fold"])
    summary = {r["metric"]: (r["mean"], r["std"]) for r in evaluate.fold_summary(per_fold).collect()}
    assert summary["AUROC"][0] > 0.95 and summary["fmax"][0] > 0.9


def test_shuffled_labels_teach_nothing(spark):
    held_out = evaluate.cross_validated_scores(separable(spark, shuffle=True), classify.logistic(0.01), 2)
    assert 0.4 < values(evaluate.report(held_out))["AUROC"] < 0.6


def test_network_stops_early(spark):
    df = separable(spark)
    model, curve = classify.train_network(df.filter("id < 300"), df.filter("id >= 300"), hidden=4, epochs=8, chunk=20)
    rows = curve.collect()
    assert max(r["epoch"] for r in rows) < 7
    last = {(r["split"], r["metric"]): r["value"] for r in rows if r["epoch"] == max(x["epoch"] for x in rows)}
    assert last[("train", "accuracy")] > 0.95 and last[("valid", "auc")] > 0.95
    assert classify.score(model, df).filter("score between 0 and 1").count() == 400


def test_weights_and_splits(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "id int, label int")
    weights = {r["id"]: r["weight"] for r in classify.balanced_weights(df).collect()}
    assert weights[1] == 2.0 and weights[2] == pytest.approx(4 / 6)
    big = spark.range(1000)
    first = classify.validation_split(big, id_cols=["id"])
    second = classify.validation_split(big, id_cols=["id"], trial=1)
    assert abs(first.filter("part = 'valid'").count() - 500) < 60
    assert first.drop("trial").exceptAll(second.drop("trial")).count() > 300


def test_hadamard(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "features array<double>")
    assert classify.hadamard(df, 2).first()["features"] == [1.0, 2.0, 3.0, 4.0, 3.0, 8.0]
