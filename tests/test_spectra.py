"""Eigenvectors of neighbour graphs against a dense solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators import clustering, neighbors, spectra
from conceptlink.operators.staging import written


def graph(spark, x, k):
    points = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, vec array<double>")
    near = written(neighbors.nearest(points, k))
    pairs = near.select("src", "dst").union(near.select("dst", "src")).distinct()
    return points, written(pairs.withColumn("affinity", F.lit(1.0)))


def rings(n):
    t = np.arange(n) * 2 * np.pi / n
    circle = np.column_stack((np.cos(t), np.sin(t)))
    return np.concatenate((circle, 4 * circle))


def dense(edges, n):
    a = np.zeros((n, n))
    for r in edges.collect():
        a[r["src"], r["dst"]] = r["affinity"]
    d = a.sum(axis=1)
    return np.linalg.eigh(np.eye(n) - a / np.sqrt(d[:, None] * d)), d


def test_leading_vectors_equal_a_dense_solver(spark):
    x = np.random.default_rng(2).normal(size=(150, 3))
    _, edges = graph(spark, x, 8)
    found, values, residuals = spectra.leading_vectors(edges, 4)
    (want, vectors), d = dense(edges, 150)
    assert np.allclose(values, want[:4], atol=1e-6) and residuals.max() < 1e-6
    rows = {r["id"]: r for r in found.collect()}
    got = np.array([rows[i]["x"] for i in range(150)])
    assert np.allclose(np.abs((got * vectors[:, :4]).sum(axis=0)), 1, atol=1e-4)
    assert np.allclose([rows[i]["degree"] for i in range(150)], d)


def test_two_rings_are_two_spectral_clusters(spark):
    points, edges = graph(spark, rings(60), 4)
    labels = {r["id"]: r["cluster_id"] for r in spectra.embedded_clusters(points.union(spark.createDataFrame([(999, [0.0, 0.0])], points.schema)), edges, 2).collect()}
    assert len({labels[i] for i in range(60)}) == len({labels[i] for i in range(60, 120)}) == 1
    assert labels[0] != labels[60] and labels[999] == -1


def test_gaps_count_repeated_eigenvalues(spark):
    _, edges = graph(spark, rings(40), 4)
    gaps = spectra.laplacian_gaps(edges, 7).orderBy("position").collect()
    (want, _), _ = dense(edges, 80)
    assert np.allclose([r["eigenvalue"] for r in gaps], want[:7], atol=1e-6)
    assert gaps[0]["eigenvalue"] == pytest.approx(0, abs=1e-6) and gaps[1]["eigenvalue"] == pytest.approx(0, abs=1e-6)
    assert gaps[-1]["gap"] is None and gaps[1]["gap"] == pytest.approx(want[2] - want[1], abs=1e-6)


def test_small_graphs_use_all_their_vectors(spark):
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0), (2, 1, 0.0)], "src long, dst long, affinity double")
    gaps = spectra.laplacian_gaps(edges, 20).orderBy("position").collect()
    assert [round(r["eigenvalue"], 6) for r in gaps] == [0.0, 2.0]
    with pytest.raises(ValueError):
        spectra.laplacian_gaps(edges.limit(0))


def test_held_graphs_need_no_join_for_a_product(spark, monkeypatch):
    _, edges = graph(spark, np.random.default_rng(3).normal(size=(90, 3)), 6)
    (want, _), _ = dense(edges, 90)
    monkeypatch.setattr(spectra, "_product", None)
    held = [r["eigenvalue"] for r in spectra.laplacian_gaps(edges, 6).orderBy("position").collect()]
    assert np.allclose(held, want[:6], atol=1e-6)


def test_large_graphs_are_joined_and_give_the_same(spark, monkeypatch):
    _, edges = graph(spark, rings(12), 4)
    held = spectra.leading_vectors(edges, 3)[1]
    monkeypatch.setattr(spectra, "HELD", 0)
    assert np.allclose(spectra.leading_vectors(edges, 3)[1], held, atol=1e-6)


def test_rows_of_a_matrix_are_computed_once_for_all_steps(spark):
    made = spark.sparkContext.accumulator(0)

    def noted(i):
        made.add(1)
        return [1.0 / (1 + i), 0.5]

    vs = F.udf(noted, "array<double>").asNondeterministic()
    rows = spark.range(150).select(F.array(F.col("id").cast("int"), F.lit(150)).alias("js"), vs("id").alias("vs"))
    m = np.zeros((150, 151))
    m[np.arange(150), np.arange(150)], m[:, 150] = 1 / (1 + np.arange(150)), 0.5
    got = clustering._singular_values(rows, 151, 3)
    assert np.allclose(got, np.linalg.svd(m)[1][:3]) and made.value == 150
