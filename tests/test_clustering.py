"""Learned clusterings on separable points, and the description of given ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators import clustering, density, neighbors, summaries
from conceptlink.plans import cluster_analysis

K = 7


@pytest.fixture(scope="module")
def blobs(spark):
    """700 points around seven centres on a circle, offsets from id hashes."""
    key = F.md5(F.col("id").cast("string"))

    def offset(start):
        return F.conv(F.substring(key, start, 6), 16, 10).cast("double") / float(16**6) * 2 - 1

    angle = F.col("label") * (2 * math.pi / K)
    df = spark.range(700).withColumn("label", (F.col("id") % K).cast("int"))
    vec = F.array(10 * F.cos(angle) + offset(1), 10 * F.sin(angle) + offset(7))
    return df.select("id", vec.alias("vec"), "label").persist()


def ari(labelled):
    return {r["metric"]: r["value"] for r in summaries.external_metrics(labelled).collect()}["ARI"]


def with_labels(blobs, found):
    return blobs.join(found.select("id", "cluster_id"), "id")


def test_kmeans_family(blobs):
    assert ari(clustering.kmeans(blobs, K, n_init=5)) > 0.95
    assert ari(with_labels(blobs, clustering.bisecting(blobs, K))) > 0.7
    assert ari(with_labels(blobs, clustering.minibatch_kmeans(blobs, K, batches=4))) > 0.5
    assert ari(with_labels(blobs, clustering.projected_kmeans(blobs, K, 2, n_init=3))) > 0.95


def test_lloyd_converges_from_one_point_per_blob(blobs):
    found, centers = clustering.lloyd(blobs, clustering.first_centers(blobs, K))
    assert ari(found) == pytest.approx(1.0)
    again, same = clustering.lloyd(blobs, centers, iterations=1)
    assert same == centers
    assert len(clustering.random_centers(blobs, 4)) == 4


def test_nearest_center_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id long, vec array<double>")
    rows = clustering.nearest_center(df, [[-1.0], [1.0], [3.0]]).orderBy("id").collect()
    assert [r["cluster_id"] for r in rows] == [0, 2]


@pytest.mark.parametrize("size", [7, 10_000])
def test_ties_do_not_hang_on_the_batch_size(spark, monkeypatch, size):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=16), rng.normal(size=16)
    middle = (a + b) / 2
    rows = [(i, middle.tolist()) for i in range(200)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    monkeypatch.setattr(clustering, "SLICE", 16 * size)
    try:
        df = spark.createDataFrame(rows, "id long, vec array<double>")
        got = clustering.nearest_center(df, [[0.0] * 15 + [1.0], [0.0] * 15 + [1.0], a.tolist()]).select("cluster_id").distinct().collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 1 and got[0][0] != 1


def test_unlinked_points_are_noise(spark):
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (2, 3, 0.01), (3, 4, 1.0), (4, 5, 1.0), (8, 9, 0.0)], "src long, dst long, affinity double")
    got = {r["id"]: r["cluster_id"] for r in clustering.spectral(edges, 2).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 8, 9} and got[8] == got[9] == -1 and min(got[i] for i in range(6)) >= 0


def test_graph_clusterings(blobs):
    assert ari(with_labels(blobs, density.single_link(blobs, 1.5, k=8))) > 0.95
    assert ari(with_labels(blobs, density.density_clusters(blobs, 1.0, 5, "euclidean"))) > 0.95
    near = neighbors.nearest(blobs, 8)
    gaps = clustering.eigengap(neighbors.local_affinity(near, 8), components=10)
    assert clustering.suggested_counts(gaps)[0] == K
    rows = gaps.orderBy("position").collect()
    assert rows[0]["eigenvalue"] < 1e-6 and [r["eigenvalue"] for r in rows] == sorted(r["eigenvalue"] for r in rows)


def test_density_ladder(blobs):
    levels = density.density_levels(blobs, min_cluster_size=20, min_points=5, shares=(0.5, 0.99))
    flat = density.flat_density_clusters(levels)
    labelled = with_labels(blobs, flat).filter("cluster_id >= 0")
    assert labelled.count() > 300
    purity = labelled.groupBy("cluster_id").agg(F.countDistinct("label").alias("n"))
    assert purity.agg(F.max("n")).first()[0] == 1


def test_spectral(spark, blobs):
    two = blobs.filter("label in (0, 3)")
    found = clustering.spectral_clusters(two, 2, affinity="self_tuning", neighbors=8)
    assert found.count() == 200
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (0, 2, 1.0), (3, 4, 1.0), (4, 5, 1.0), (3, 5, 1.0), (2, 3, 0.01)], "src long, dst long, affinity double")
    groups = {r["id"]: r["cluster_id"] for r in clustering.spectral(edges, 2, 40).collect()}
    assert len(groups) == 6


def test_choosing_k(blobs):
    gaps = clustering.gap_statistic(blobs, [1, 3, 5, 7, 9], references=3, n_init=3)
    assert clustering.best_by_gap(gaps) == K
    scan = clustering.silhouette_scan(blobs, [5, 7, 9], seed=12)
    assert scan.count() == 3 and clustering.best_by_silhouette(scan) in (5, 7, 9)
    inertia = clustering.gap_statistic(blobs, [1, 7], references=2, form="inertia", box="unit", n_init=3)
    assert inertia.count() == 2


def test_reference_points_fill_the_box(blobs):
    rows = np.array([r["vec"] for r in clustering.reference_points(blobs, [(0.0, 1.0), (5.0, 9.0)], 0).collect()])
    assert rows.shape == (700, 2)
    assert rows[:, 0].min() >= 0 and rows[:, 0].max() < 1 and rows[:, 1].min() >= 5 and rows[:, 1].max() < 9
    assert np.allclose(rows.mean(axis=0), [0.5, 7.0], atol=0.15)


def given(spark):
    rows = [(0, 0, 0), (1, 1, 1), (2, 1, 0), (3, 0, 0)]
    return spark.createDataFrame([(i, [float(i), 1.0], c, y) for i, c, y in rows], "id long, vec array<double>, cluster_id int, label int")


def test_map_clusters(spark):
    df = given(spark)
    got = {(r["cluster_id"], r["id"]): r["label"] for r in summaries.map_clusters(df).collect()}
    # both clusters have majority label 0, so their ids stay
    assert got == {(0, 0): 0, (0, 3): 0, (1, 1): 1, (1, 2): 0}
    moved = df.withColumn("label", 5 - F.col("cluster_id"))
    assert {r["cluster_id"] for r in summaries.map_clusters(moved).collect()} == {4, 5}
    assert {r["cluster_id"] for r in summaries.map_clusters(moved, relabel=False).collect()} == {0, 1}
    assert summaries.merge_clusters(df, [1, 42]).count() == 2 and summaries.merge_clusters(df).count() == 4


def test_distribution_has_zero_cells(spark):
    rows = {(r["cluster_id"], r["label"]): (r["n"], r["share"]) for r in summaries.label_distribution(given(spark)).collect()}
    assert rows == {(0, 0): (2, 1.0), (0, 1): (0, 0.0), (1, 0): (1, 0.5), (1, 1): (1, 0.5)}


def test_agreement_extremes(spark):
    same = spark.createDataFrame([(i, i % 3, i % 3) for i in range(30)], "id long, cluster_id int, label int")
    assert all(r["value"] == pytest.approx(1.0) for r in summaries.external_metrics(same).collect())
    one = same.withColumn("cluster_id", F.lit(0))
    got = {r["metric"]: r["value"] for r in summaries.external_metrics(one).collect()}
    assert got["homogeneity"] == pytest.approx(0.0) and got["completeness"] == 1.0 and got["ARI"] == pytest.approx(0.0)


def test_expected_information_in_short_runs(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 3, size=(200, 2)))]
    df = spark.createDataFrame(rows, "id long, cluster_id int, label int")
    whole = {r["metric"]: r["value"] for r in summaries.external_metrics(df).collect()}
    monkeypatch.setattr(summaries, "EMI_STEP", 5)
    cut = {r["metric"]: r["value"] for r in summaries.external_metrics(df).collect()}
    assert cut["AMI"] == pytest.approx(whole["AMI"], abs=1e-12)


def test_silhouettes_match_pairs(spark):
    rng = np.random.default_rng(6)
    x, c = rng.normal(size=(40, 3)), rng.integers(0, 3, 40)
    c[0] = 9  # a cluster of one
    df = spark.createDataFrame([(i, x[i].tolist(), int(c[i])) for i in range(40)], "id long, vec array<double>, cluster_id int")
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    got = {r["id"]: r["silhouette"] for r in summaries.silhouettes(df).collect()}
    for i in range(40):
        own = (c == c[i]).sum()
        a = d[i, c == c[i]].sum() / max(own - 1, 1)
        b = min(d[i, c == other].mean() for other in set(c) - {c[i]})
        assert got[i] == pytest.approx(0.0 if own == 1 else (b - a) / max(a, b), abs=1e-9)
    assert summaries.silhouette_score(df, sample=20).first()[0] is not None


def test_top_members_and_dispersion(spark):
    df = spark.createDataFrame([(i, [1.0, i / 10], 0) for i in range(6)], "id long, vec array<double>, cluster_id int")
    centers = spark.createDataFrame([(0, [1.0, 0.0], 6)], "cluster_id int, center array<double>, size long")
    ids = lambda order: [r["id"] for r in summaries.top_members(df, 2, centers, order=order).orderBy("rank").collect()]
    assert ids("nearest") == [0, 1] and ids("farthest") == [5, 4]
    assert summaries.dispersion(df, centers).first()["wk"] == pytest.approx(sum((i / 10) ** 2 for i in range(6)) / 12)
    box = [(r["low"], r["high"]) for r in summaries.bounding_box(df).orderBy("dim").collect()]
    assert box == [(1.0, 1.0), (0.0, 0.5)]


def test_analysis_and_saved_results(spark, blobs, tmp_path):
    from conceptlink.sources import results

    path = str(tmp_path / "out")
    tags = blobs.select("label").distinct().withColumn("tag", F.concat(F.lit("t"), "label"))
    found = cluster_analysis.analyze(blobs, "kmeans", k=K, labelled=True, path=path, identifier="run", tags=tags)
    metrics = {r["metric"]: r["value"] for r in found.metrics.collect()}
    assert metrics["ARI"] > 0.95 and metrics["silhouette"] > 0.8
    assert found.centers.count() == K and found.top.count() == 10 * K and found.distribution.count() == K * K
    saved = spark.read.csv(f"{path}/cluster_id-run.csv", header=True)
    assert saved.columns == ["id", "cluster_id", "label", "tag"] and saved.count() == 700
    lists = spark.read.csv(f"{path}/cluster_knnmap-run.csv", header=True, sep="|").collect()
    assert len(lists) == K and all(len(r["knn"].split(",")) == 10 for r in lists)
    again = results.load_clusters(spark, path, "run", blobs)
    assert again.count() == 700
    with pytest.raises(Exception, match="no saved cluster"):
        more = blobs.select("id").union(spark.range(5000, 5001))
        results.load_clusters(spark, path, "run", more).collect()
    reused = cluster_analysis.analyze(found.assignments, method=None, k=K)
    assert reused.metrics.count() == 1
    with pytest.raises(NotImplementedError):
        cluster_analysis.cluster_with(blobs, "unknown", 3)
