"""Neighbour joins and density clusters against brute force, over many small blocks and with copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators import components, density, neighbors
from conceptlink.operators.components import connected_components


def frame(spark, x, parts=5):
    rows = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(parts)


def blobs(n=160, d=4, copies=60, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + rng.integers(0, 4, size=(n, 1)) * 4.0
    # a third of all rows are copies of one row
    return np.vstack([x, np.repeat(x[:1], copies, axis=0), x[5:9]])


def distances(x, metric):
    if metric == "cosine":
        u = x / np.linalg.norm(x, axis=1)[:, None]
        return 1 - u @ u.T
    return np.linalg.norm(x[:, None] - x[None], axis=2)


@pytest.mark.parametrize("metric,radius", [("euclidean", 1.7), ("cosine", 0.05)])
def test_close_pairs_match_brute_force(spark, metric, radius):
    x = blobs()
    d = distances(x, metric)
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if d[i, j] <= radius}
    found = neighbors.close_pairs(frame(spark, x), radius, metric, block=16).collect()
    got = [(r["src"], r["dst"]) for r in found]
    assert len(got) == len(set(got))
    assert set(got) == want
    assert all(abs(r["distance"] - d[r["src"], r["dst"]]) < 1e-6 for r in found)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_nearest_matches_brute_force(spark, metric):
    x = blobs()
    k = 6
    d = distances(x, metric)
    np.fill_diagonal(d, np.inf)
    rows = neighbors.nearest(frame(spark, x), k, metric, block=16).collect()
    got = {}
    for r in rows:
        got.setdefault(r["src"], []).append((r["rank"], r["dst"], r["distance"]))
    assert len(got) == len(x)
    for i in range(len(x)):
        near = sorted(got[i])
        assert [r for r, _, _ in near] == list(range(1, k + 1))
        order = np.lexsort((np.arange(len(x)), np.round(d[i], 9)))[:k]
        assert np.allclose([v for _, _, v in near], d[i][order], atol=1e-6)
        if metric == "euclidean":
            assert [j for _, j, _ in near] == order.tolist()


def brute_density(x, eps, min_points, metric):
    d = distances(x, metric)
    near = d <= eps
    core = near.sum(axis=1) >= min_points
    comp = np.arange(len(x))
    while True:
        low = np.array([comp[near[i] & core].min() if core[i] else comp[i] for i in range(len(x))])
        if (low == comp).all():
            break
        comp = low
    names = {c: n for n, c in enumerate(sorted(set(comp[core])))}
    label = []
    for i in range(len(x)):
        touched = comp[near[i] & core]
        label.append(names[comp[i]] if core[i] else (names[touched.min()] if len(touched) else -1))
    return label, core


@pytest.mark.parametrize("metric,eps", [("euclidean", 1.2), ("cosine", 0.02)])
def test_density_matches_brute_force(spark, metric, eps):
    x = blobs()
    want, core = brute_density(x, eps, 4, metric)
    rows = density.density_clusters(frame(spark, x), eps, 4, metric, block=16).orderBy("id").collect()
    assert [r["cluster_id"] for r in rows] == want
    assert [r["is_core"] for r in rows] == core.tolist()
    assert len(set(want)) > 2


def test_density_chain(spark):
    df = frame(spark, np.array([[0.0], [1.0], [2.0], [10.0], [11.0], [50.0]]))
    rows = density.density_clusters(df, 1.5, 2, "euclidean").orderBy("id").collect()
    assert [r["cluster_id"] for r in rows] == [0, 0, 0, 1, 1, -1]
    count = density.cluster_count(spark.createDataFrame(rows)).first()[0]
    assert count == 2


def test_components_of_a_long_chain_a_star_and_loners(spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = spark.createDataFrame(chain + star, "src long, dst long")
    vertices = spark.range(90, 1310)
    got = {r["id"]: r["component"] for r in connected_components(vertices, edges).collect()}
    assert all(got[i] == 100 for i in range(100, 401))
    assert all(got[i] == 1000 for i in range(1000, 1300))
    assert all(got[i] == i for i in [*range(90, 100), *range(401, 1000), *range(1300, 1310)])


def test_estimated_radius_is_mean_of_median_and_minimum(spark):
    df = frame(spark, np.array([[0.0], [1.0], [5.0]]))
    assert neighbors.estimate_radius(df, metric="euclidean") == pytest.approx((4.0 + 1.0) / 2)


def test_local_affinity_of_equal_rows_is_one(spark):
    near = spark.createDataFrame(
        [(1, 2, 0.0, 1), (2, 1, 0.0, 1), (3, 1, 2.0, 1)], "src long, dst long, distance double, rank int"
    )
    rows = {(r["src"], r["dst"]): r["affinity"] for r in neighbors.local_affinity(near, 1).collect()}
    assert rows[(1, 2)] == rows[(2, 1)] == 1.0
    assert rows[(1, 3)] == 0.0
    assert (1, 1) not in rows


def test_rows_travel_to_few_regions_however_many_cells_there_are(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    points = frame(spark, x)
    seen = []
    real = neighbors._visits

    def visits(*args):
        out = real(*args)
        seen.append(out.select(F.size("regions").alias("n")).agg(F.max("n")).first()[0])
        return out

    monkeypatch.setattr(neighbors, "_visits", visits)
    got = {(r["src"], r["rank"]): r["dst"] for r in neighbors.nearest(points, 5, block=8).collect()}
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert got == {(i, j + 1): int(n) for i, row in enumerate(np.argsort(d, axis=1)[:, :5]) for j, n in enumerate(row)}
    assert 1 < seen[0] <= 8  # 50 cells, 4 cores
    one, many = (density.density_clusters(points, 1.2, 4, "euclidean", block).collect() for block in (2048, 8))
    assert sorted(one) == sorted(many) and len({r["cluster_id"] for r in one}) > 1


def test_near_pairs_hold_the_nearest_at_any_scale():
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(300, 6))
    crowded = np.vstack([1e-7 * rng.normal(size=(200, 6)), rng.normal(size=(100, 6))])
    for rows in (spread, 1e5 + spread, 1e-6 * spread, crowded):
        x, y = rows[:120], rows[100:]
        d = np.linalg.norm(x[:, None] - y, axis=2)
        for radius in (np.inf, float(np.median(d))):
            i, j, exact = neighbors._near_pairs(x, y, np.full(len(x), radius), 4)
            assert np.allclose(exact, d[i, j]) and len(set(zip(i, j))) == len(i)
            got = set(zip(i.tolist(), j.tolist()))
            for row in range(len(x)):
                assert all((row, c) in got for c in np.argsort(d[row])[:5] if d[row, c] <= radius)


def test_few_pairs_are_measured_of_many(monkeypatch):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(256, 16)), rng.normal(size=(512, 16))
    monkeypatch.setattr(neighbors, "_distances", None)
    i, _, _ = neighbors._near_pairs(x, y, np.full(256, np.inf), 4)
    assert 256 * 5 <= len(i) <= 256 * 6
