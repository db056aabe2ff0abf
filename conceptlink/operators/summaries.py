"""Describing and scoring a clustering that is already there.

Points are ``(id, vec array<double>, cluster_id[, label])`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from conceptlink.functions import vec as vx
from conceptlink.operators.corpus import metric_rows
from conceptlink.operators.ranking import exact_median
from conceptlink.operators.sampling import stratified_sample
from conceptlink.operators.staging import written
from conceptlink.operators.vectors import dimension

Metric = Callable[[Column, Column], Column]
EMI_STEP = 100_000  # terms of the expected-information sum per row


def majority_labels(assignments: DataFrame) -> DataFrame:
    """Most frequent label of each cluster, the smallest label on a tie."""
    counts = assignments.groupBy("cluster_id", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(-F.col("n"), F.col("label").alias("majority")))
    return counts.groupBy("cluster_id").agg(best["majority"].alias("majority"))


def map_clusters(assignments: DataFrame, relabel: bool = True) -> DataFrame:
    """``(cluster_id, id, label)`` members; clusters take their majority label as id
    when no two clusters share one.

    A flat table rather than lists: a cluster may hold any share of all rows.
    """
    if not relabel:
        return assignments.select("cluster_id", "id", "label")
    names = majority_labels(assignments)
    # one row per cluster
    sharing = names.withColumn("_sharing", F.count(F.lit(1)).over(Window.partitionBy("majority")))
    sharing = sharing.withColumn("_most", F.max("_sharing").over(Window.partitionBy()))
    new_id = F.when(F.col("_most") == 1, F.col("majority")).otherwise(F.col("cluster_id"))
    renamed = sharing.select("cluster_id", new_id.alias("_new"))
    return assignments.join(renamed, "cluster_id").select(F.col("_new").alias("cluster_id"), "id", "label")


def merge_clusters(assignments: DataFrame, cluster_ids: list[int] | None = None) -> DataFrame:
    """Members of the chosen clusters (all without a choice); unknown ids add nothing."""
    if not cluster_ids:
        return assignments
    return assignments.filter(F.col("cluster_id").isin(cluster_ids))


def cluster_means(points: DataFrame) -> DataFrame:
    """``(cluster_id, center, size)``."""
    dim = dimension(points)
    sums = points.groupBy("cluster_id").agg(
        F.array(*[F.avg(F.col("vec")[i]) for i in range(dim)]).alias("center"), F.count(F.lit(1)).alias("size")
    )
    return sums


def dimension_medians(points: DataFrame) -> DataFrame:
    """``(cluster_id, dim, median)``, exact."""
    values = points.select("cluster_id", F.posexplode("vec").alias("dim", "v"))
    return exact_median(values, ["cluster_id", "dim"], "v")


def cluster_medians(points: DataFrame) -> DataFrame:
    """``(cluster_id, center)`` of per-dimension medians; a list is as long as a vector."""
    ordered = F.array_sort(F.collect_list(F.struct("dim", "median")))
    return dimension_medians(points).groupBy("cluster_id").agg(F.transform(ordered, lambda s: s["median"]).alias("center"))


def top_members(
    points: DataFrame,
    k: int = 10,
    centers: DataFrame | None = None,
    metric: Metric = vx.cosine_distance,
    order: str = "nearest",
) -> DataFrame:
    """``(cluster_id, rank, id, distance)``: k members nearest to (or farthest from) the centre.

    The rank filter keeps k rows per cluster in every task before the shuffle.
    """
    centers = cluster_means(points) if centers is None else centers
    far = points.join(centers.select("cluster_id", "center"), "cluster_id").select(
        "cluster_id", "id", metric(F.col("vec"), F.col("center")).alias("distance")
    )
    by = F.asc("distance") if order == "nearest" else F.desc("distance")
    w = Window.partitionBy("cluster_id").orderBy(by, "id")
    return far.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _known_values(df: DataFrame, column: str) -> list:
    """Distinct labels or cluster ids; their number is that of the report's columns."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def label_distribution(assignments: DataFrame) -> DataFrame:
    """``(cluster_id, label, n, share)`` for every cluster and label, zeros included."""
    counts = written(assignments.groupBy("cluster_id", "label").agg(F.count(F.lit(1)).alias("n")))
    labels = F.array(*[F.lit(v) for v in _known_values(counts, "label")])
    sizes = counts.groupBy("cluster_id").agg(F.sum("n").alias("size"))
    grid = sizes.select("cluster_id", "size", F.explode(labels).alias("label"))
    filled = grid.join(counts, ["cluster_id", "label"], "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return filled.select("cluster_id", "label", n.alias("n"), (n / F.col("size")).alias("share"))


# --- agreement with known labels -------------------------------------------------------


@F.pandas_udf(DoubleType())
def _expected_terms(a: pd.Series, b: pd.Series, n: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    """Sum of the expected-information terms for counts first..last of one (a, b) pair."""

    def one(a: int, b: int, n: int, first: int, last: int) -> float:
        log_p = (
            math.lgamma(a + 1) + math.lgamma(b + 1) + math.lgamma(n - a + 1) + math.lgamma(n - b + 1)
            - math.lgamma(n + 1) - math.lgamma(first + 1) - math.lgamma(a - first + 1)
            - math.lgamma(b - first + 1) - math.lgamma(n - a - b + first + 1)
        )
        m = np.arange(first, last + 1, dtype=float)
        steps = np.log((a - m[:-1]) * (b - m[:-1])) - np.log(m[1:] * (n - a - b + m[1:]))
        log_ps = log_p + np.concatenate([[0.0], np.cumsum(steps)])
        return float(np.sum(m / n * np.log(n * m / (a * b)) * np.exp(log_ps)))

    return pd.Series([one(*map(int, row)) for row in zip(a, b, n, first, last)], dtype=float)


def _expected_information(counts: DataFrame, total: int) -> DataFrame:
    """Expected mutual information of two labelings with the given class sizes."""
    columns = counts.groupBy("label").agg(F.sum("n").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("times"))
    sizes = F.array(*[F.struct(F.lit(r["b"]).alias("b"), F.lit(r["times"]).alias("m")) for r in columns.collect()])
    rows = counts.groupBy("cluster_id").agg(F.sum("n").alias("a")).groupBy("a").agg(F.count(F.lit(1)).alias("times"))
    cells = rows.select("a", "times", F.explode(sizes).alias("s")).select("a", "s.b", (F.col("times") * F.col("s.m")).alias("times"))
    low = F.greatest(F.lit(1), F.col("a") + F.col("b") - total)
    high = F.least("a", "b")
    # a large cell is many short sums, spread over the tasks
    chunks = cells.withColumn("high", high).withColumn("first", F.explode(F.sequence(low, high, F.lit(EMI_STEP))))
    chunks = chunks.withColumn("last", F.least(F.col("first") + EMI_STEP - 1, "high"))
    part = _expected_terms("a", "b", F.lit(total), "first", "last") * F.col("times")
    return chunks.repartition("a", "b", "first").agg(F.sum(part).alias("emi"))


def external_metrics(assignments: DataFrame) -> DataFrame:
    """Homogeneity, completeness, V-measure, ARI and AMI as ``(metric, value)`` rows."""
    counts = written(assignments.groupBy("cluster_id", "label").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    n = F.lit(float(total))

    def pairs_of(c: str) -> Column:
        return F.col(c) * (F.col(c) - 1) / 2.0

    def side(column: str, prefix: str) -> DataFrame:
        sums = counts.groupBy(column).agg(F.sum("n").cast("double").alias("s"))
        return sums.agg(
            F.sum(pairs_of("s")).alias(f"{prefix}_pairs"),
            (-F.sum(F.col("s") / n * F.log(F.col("s") / n))).alias(f"{prefix}_entropy"),
        )

    by_cluster = counts.groupBy("cluster_id").agg(F.sum("n").alias("a"))
    by_label = counts.groupBy("label").agg(F.sum("n").alias("b"))
    cells = counts.withColumn("n", F.col("n").cast("double")).join(by_cluster, "cluster_id").join(by_label, "label")
    cell = cells.agg(
        F.sum(pairs_of("n")).alias("cell_pairs"),
        F.sum(F.col("n") / n * F.log(n * F.col("n") / (F.col("a") * F.col("b")))).alias("mi"),
    )
    parts = [cell, side("cluster_id", "cluster"), side("label", "label"), _expected_information(counts, total)]
    long = metric_rows(parts[0])
    for p in parts[1:]:
        long = long.unionByName(metric_rows(p))
    names = ["cell_pairs", "mi", "cluster_pairs", "cluster_entropy", "label_pairs", "label_entropy", "emi"]
    wide = long.agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])

    c = F.col
    homogeneity = F.when(c("label_entropy") > 0, c("mi") / c("label_entropy")).otherwise(1.0)
    completeness = F.when(c("cluster_entropy") > 0, c("mi") / c("cluster_entropy")).otherwise(1.0)
    all_pairs = n * (n - 1) / 2.0
    expected = c("cluster_pairs") * c("label_pairs") / all_pairs
    highest = (c("cluster_pairs") + c("label_pairs")) / 2.0
    mean_entropy = (c("cluster_entropy") + c("label_entropy")) / 2.0
    scores = wide.select(
        homogeneity.alias("homogeneity"),
        completeness.alias("completeness"),
        F.when(homogeneity + completeness > 0, 2 * homogeneity * completeness / (homogeneity + completeness))
        .otherwise(0.0)
        .alias("v_measure"),
        F.when(highest != expected, (c("cell_pairs") - expected) / (highest - expected)).otherwise(1.0).alias("ARI"),
        F.when(F.abs(mean_entropy - c("emi")) > 1e-15, (c("mi") - c("emi")) / (mean_entropy - c("emi")))
        .otherwise(1.0)
        .alias("AMI"),
    )
    return metric_rows(scores)


# --- silhouette ------------------------------------------------------------------------


def silhouettes(points: DataFrame) -> DataFrame:
    """``(id, cluster_id, silhouette)`` under squared Euclidean distance, exact for every row.

    The mean squared distance of a point to a cluster follows from the cluster's
    size, vector sum and sum of squares, so no pairs are formed. What each task
    gets is one such summary per cluster, the size of a k-means model.
    """
    dim = dimension(points)
    squares = vx.dot(F.col("vec"), F.col("vec"))
    summary = (
        points.groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(squares).alias("q"),
            F.array(*[F.sum(F.col("vec")[i]) for i in range(dim)]).alias("s"),
        )
        .orderBy("cluster_id")
        .collect()
    )
    place = {r["cluster_id"]: i for i, r in enumerate(summary)}
    n = np.array([r["n"] for r in summary], dtype=float)
    q = np.array([r["q"] for r in summary])
    s = np.array([r["s"] for r in summary])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["vec"].to_numpy())
            own = pdf["cluster_id"].map(place).to_numpy()
            rows = np.arange(len(x))
            sums = (x * x).sum(axis=1)[:, None] * n - 2.0 * x @ s.T + q
            size = n[own]
            a = sums[rows, own] / np.maximum(size - 1, 1)
            means = sums / n
            means[rows, own] = np.inf
            b = means.min(axis=1)
            top = np.maximum(a, b)
            value = np.where((size > 1) & np.isfinite(b) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)
            yield pd.DataFrame({"id": pdf["id"], "cluster_id": pdf["cluster_id"], "silhouette": value})

    kinds = dict(points.dtypes)
    schema = f"id {kinds['id']}, cluster_id {kinds['cluster_id']}, silhouette double"
    return points.select("id", "cluster_id", "vec").mapInPandas(score, schema)


def silhouette_score(points: DataFrame, sample: int | None = None, seed: int = 7) -> DataFrame:
    """Mean silhouette, of all rows or of a sample drawn in proportion to the clusters."""
    if sample:
        points = written(stratified_sample(points, sample, ["id"], "cluster_id", seed=seed))
    return silhouettes(points).agg(F.avg("silhouette").alias("silhouette"))


def dispersion(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Within-cluster dispersion: squared distances to the centre over twice the cluster size, summed."""
    joined = points.join(centers.select("cluster_id", "center", "size"), "cluster_id")
    return joined.agg(F.sum(vx.squared_euclidean(F.col("vec"), F.col("center")) / (2 * F.col("size"))).alias("wk"))


def bounding_box(points: DataFrame) -> DataFrame:
    """``(dim, low, high)`` of any number of dimensions."""
    dim = dimension(points)
    box = points.agg(
        F.array(
            *[
                F.struct(F.lit(i).alias("dim"), F.min(F.col("vec")[i]).alias("low"), F.max(F.col("vec")[i]).alias("high"))
                for i in range(dim)
            ]
        ).alias("box")
    )
    return box.select(F.explode("box").alias("b")).select("b.dim", "b.low", "b.high")
