"""Training and scoring relatedness classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from conceptlink.functions.hashing import below, order_key
from conceptlink.operators.sampling import class_sizes


def as_features(df: DataFrame, column: str = "features") -> DataFrame:
    """Feature array column to the vector type the learners take."""
    kind = dict(df.dtypes)[column]
    return df.withColumn(column, array_to_vector(column)) if kind.startswith("array") else df


def hadamard(df: DataFrame, dim: int, column: str = "features") -> DataFrame:
    """Append the product of the two halves of a pair vector.

    A linear model on the plain concatenation cannot tell how document and
    concept interact; this lets it. Off unless called.
    """
    f = F.col(column)
    product = F.zip_with(F.slice(f, 1, dim), F.slice(f, dim + 1, dim), lambda a, b: a * b)
    return df.withColumn(column, F.concat(f, product))


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Row weights n / (classes * class size)."""
    sizes = class_sizes(df, label).collect()  # one row per class
    total = sum(r["n"] for r in sizes)
    weight = F.create_map(*[F.lit(x) for r in sizes for x in (r[label], total / (len(sizes) * r["n"]))])
    return df.withColumn(out, weight[F.col(label)])


def random_forest(trees: int = 500, depth: int = 10, leaf: int = 10, seed: int = 53) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)


def logistic(reg: float = 1.0, l1_ratio: float = 0.0, weights: str | None = None) -> LogisticRegression:
    model = LogisticRegression(regParam=reg, elasticNetParam=l1_ratio)
    return model.setWeightCol(weights) if weights else model


def score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Add P(label = 1); works on batch and streaming frames."""
    scored = model.transform(as_features(df))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def _quality(model, df: DataFrame, label: str) -> dict[str, float]:
    scored = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    p = F.least(F.greatest(F.col("_p"), F.lit(1e-7)), F.lit(1 - 1e-7))
    y = F.col(label).cast("double")
    row = scored.agg(
        F.avg((F.col("prediction") == y).cast("double")).alias("accuracy"),
        (-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("loss"),
    ).first()
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability").evaluate(scored)
    return {"accuracy": row["accuracy"], "auc": auc, "loss": row["loss"]}


def train_network(
    train: DataFrame,
    valid: DataFrame | None = None,
    hidden: int = 100,
    epochs: int = 10,
    chunk: int = 10,
    stop_accuracy: float = 0.95,
    label: str = "label",
    seed: int = 53,
) -> tuple[MultilayerPerceptronClassificationModel, DataFrame]:
    """Network with one hidden layer on pair vectors, and its training curve.

    Training goes on in chunks of iterations from the last weights and stops
    once the training accuracy passes ``stop_accuracy``. The curve has
    ``(epoch, split, metric, value)`` rows. Spark's network has sigmoid hidden
    units and neither dropout nor an L2 term.
    """
    train = as_features(train).select("features", label)
    width = len(train.select(vector_to_array("features").alias("f")).first()["f"])
    splits = {"train": train}
    if valid is not None:
        splits["valid"] = as_features(valid).select("features", label)
    learner = MultilayerPerceptronClassifier(layers=[width, hidden, 2], labelCol=label, maxIter=chunk, seed=seed)
    train.persist()
    try:
        curve, model = [], None
        for epoch in range(epochs):
            if model is not None:
                learner = learner.setInitialWeights(model.weights)
            model = learner.fit(train)
            for split, df in splits.items():
                quality = _quality(model, df, label)
                curve += [(epoch, split, metric, float(value)) for metric, value in quality.items()]
                if split == "train":
                    reached = quality["accuracy"] > stop_accuracy
            if reached:
                break
    finally:
        train.unpersist()
    schema = "epoch int, split string, metric string, value double"
    return model, train.sparkSession.createDataFrame(curve, schema)


def validation_split(
    df: DataFrame, share: float = 0.5, id_cols: Sequence[str] = ("doc_id", "concept"), trial: int = 0, seed: int = 53
) -> DataFrame:
    """Halve the unseen-concept set into ``part`` 'valid' and 'test'; each trial cuts it anew."""
    valid = below(order_key(seed, F.lit(str(trial)), *id_cols), share)
    return df.withColumn("trial", F.lit(trial)).withColumn("part", F.when(valid, "valid").otherwise("test"))
