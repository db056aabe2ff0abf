"""Many k-means models in one scan, and neighbour descent, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators import clustering, descent, many_kmeans, summaries
from conceptlink.operators.many_kmeans import Model
from conceptlink.operators.staging import partition_keys

K = 5


def frame(spark, x, parts=5):
    rows = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(50, 3)) + c for c in 12.0 * rng.normal(size=(K, 3))])
    return np.vstack([x, np.repeat(x[:1], 60, axis=0)])  # copies of one row


@pytest.fixture(scope="module")
def points(spark, data):
    return frame(spark, data).persist()


def lloyd(x, centers):
    while True:
        near = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(len(centers))])
        if np.abs(moved - centers).max() < 1e-9:
            return centers, ((x - centers[near]) ** 2).sum()
        centers = moved


def test_every_model_ends_where_plain_steps_from_its_start_end(points, data):
    asked = [Model(k, s) for k in (1, 2, 5, 8) for s in range(3)]
    starts = many_kmeans._started(points, asked, None, 7, 3)
    fits = many_kmeans.fit_many(points, asked, tol=1e-9)
    for start, fit in zip(starts, fits):
        centers, cost = lloyd(data, start.centers)
        assert np.allclose(fit.centers, centers, atol=1e-6) and fit.cost == pytest.approx(cost)


def test_models_that_take_turns_give_the_same(points, monkeypatch):
    asked = [Model(k, s) for k in (2, 5) for s in range(2)]
    whole = [m.cost for m in many_kmeans.fit_many(points, asked)]
    monkeypatch.setattr(many_kmeans, "CENTERS", 1)
    monkeypatch.setattr(many_kmeans, "SLICE", 7)
    assert [m.cost for m in many_kmeans.fit_many(points, asked)] == pytest.approx(whole)


def test_silhouettes_of_all_models_equal_those_one_by_one(points):
    fits = many_kmeans.fit_many(points, [Model(2), Model(5), Model(9)])
    want = []
    for m in fits:
        labelled = clustering.nearest_center(points, m.centers.tolist())
        want.append(summaries.silhouette_score(labelled).first()[0])
    assert many_kmeans.mean_silhouettes(points, fits) == pytest.approx(want)
    scan = {r["k"]: r["silhouette"] for r in many_kmeans.scan_numbers(points, range(2, 9), n_init=5).collect()}
    assert max(scan, key=scan.get) == K and len(scan) == 7


def test_gaps_over_reference_copies(points, data):
    # without the copies, which are a sixth cluster of their own
    gaps = many_kmeans.gap_scan(points.filter("id < 250"), range(1, 9), references=6, n_init=5)
    assert clustering.best_by_gap(gaps, "first") == K
    rows = {r["k"]: r for r in many_kmeans.gap_scan(points, [1], references=2).collect()}
    assert rows[1]["log_w"] == pytest.approx(np.log(((data - data.mean(axis=0)) ** 2).sum()))
    box = np.stack([data.min(axis=0), data.max(axis=0)])
    copy = np.array([r["vec"] for r in clustering.reference_points(points, list(zip(*box)), 0).collect()])
    fit = many_kmeans.fit_many(points, [Model(1, copy=0)], box)[0]
    assert np.allclose(fit.centers[0], copy.mean(axis=0)) and fit.cost == pytest.approx(((copy - copy.mean(axis=0)) ** 2).sum())
    mean_first = many_kmeans.gap_scan(points, [1, 5], references=2, form="tibshirani", unit_box=True, n_init=1)
    assert mean_first.count() == 2


def test_too_few_rows_or_no_box(points):
    with pytest.raises(ValueError):
        many_kmeans.fit_many(points.limit(3), [Model(4)])
    with pytest.raises(ValueError):
        many_kmeans.fit_many(points, [Model(2, copy=0)])


# --- neighbour descent -----------------------------------------------------------------


def recall(found, x, k, metric):
    y = x / np.linalg.norm(x, axis=1)[:, None] if metric == "cosine" else x
    d = np.linalg.norm(y[:, None] - y[None], axis=2)
    np.fill_diagonal(d, np.inf)
    kth = np.sort(d, axis=1)[:, k - 1]
    hit = 0
    for r in found:
        true = d[r["src"], r["dst"]]
        assert r["distance"] == pytest.approx(true * true / 2 if metric == "cosine" else true, abs=1e-6)
        hit += true <= kth[r["src"]] + 1e-9
    return hit / (len(x) * k)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_descent_finds_nine_of_ten_neighbours(spark, metric, monkeypatch):
    monkeypatch.setattr(descent, "SLOT", 64)
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(700, 12)) + 2.0 * rng.integers(0, 3, size=(700, 1)), np.ones((90, 12)), rng.normal(size=(10, 12)).round(0) + 0.5])
    found = descent.descent_neighbors(frame(spark, x), 8, metric).collect()
    ranks = {}
    for r in found:
        ranks.setdefault(r["src"], []).append(r["rank"])
    assert len(ranks) == len(x) and all(sorted(v) == list(range(1, 9)) for v in ranks.values())
    assert len({(r["src"], r["dst"]) for r in found}) == len(found) and all(r["src"] != r["dst"] for r in found)
    assert recall(found, x, 8, metric) >= 0.9


def test_descent_on_fewer_rows_than_neighbours(spark):
    found = descent.descent_neighbors(frame(spark, np.array([[0.0, 1.0], [2.0, 0.0], [9.0, 9.0], [9.0, 9.0]])), 8).collect()
    assert {(r["src"], r["dst"]) for r in found} == {(a, b) for a in range(4) for b in range(4) if a != b}
    assert descent.descent_neighbors(frame(spark, np.ones((1, 2))), 3).count() == 0


def test_draws_of_reference_rows_are_those_of_spark(spark):
    ids = spark.createDataFrame([(0,), (7,), (-3,), (2**60,)], "id long")
    span = F.lit(float(1 << 52))
    draw = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.pmod(F.xxhash64(F.lit(7), F.lit(4), "id", i), F.lit(1 << 52)) / span)
    rows = ids.select(F.xxhash64(F.lit(7), F.lit(4), "id").alias("h"), draw.alias("u")).collect()
    assert many_kmeans._uniform(np.array([r["h"] for r in rows]), 7).tolist() == [r["u"] for r in rows]


def test_a_table_in_one_file_is_scanned_by_all_cores(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=2).tolist()) for i in range(200)]
    spark.createDataFrame(rows, "id long, vec array<double>").coalesce(1).write.parquet(str(tmp_path / "p"))
    seen, real = [], many_kmeans.fit_many

    def noted(points, *args, **kw):
        seen.append(points.rdd.getNumPartitions())
        return real(points, *args, **kw)

    monkeypatch.setattr(many_kmeans, "fit_many", noted)
    points = spark.read.parquet(str(tmp_path / "p"))
    many_kmeans.gap_scan(points, [1, 2], references=2)
    many_kmeans.scan_numbers(points, [2], n_init=1)
    assert min(seen) >= spark.sparkContext.defaultParallelism


def test_projection_computes_its_points_once(spark):
    made = spark.sparkContext.accumulator(0)

    def noted(i):
        made.add(1)
        return [float(i % 7), float(i % 3), float(i)]

    vec = F.udf(noted, "array<double>").asNondeterministic()
    points = spark.range(60).select("id", vec("id").alias("vec"))
    assert clustering.projected_kmeans(points, 2, 2, n_init=1).count() == 60
    assert made.value == 60


def test_models_of_a_held_table_end_where_the_scans_end(points, data, monkeypatch):
    box = np.stack([data.min(axis=0), data.max(axis=0)])
    asked = [Model(k, 0, c) for k in (1, 3, 60) for c in (-1, 0)]
    held = many_kmeans.fit_many(points, asked, box)
    monkeypatch.setattr(many_kmeans, "HELD", 0)
    for a, b in zip(held, many_kmeans.fit_many(points, asked, box)):
        assert (a.k, a.start, a.copy, a.steps) == (b.k, b.start, b.copy, b.steps)
        assert np.allclose(a.centers, b.centers, atol=1e-9) and a.cost == pytest.approx(b.cost)


def test_each_group_of_models_has_a_task_of_its_own(spark):
    keys = partition_keys(spark, 13)
    dealt = spark.createDataFrame([(k,) for k in keys], "key int").repartition(13, "key")
    assert dealt.select(F.spark_partition_id()).distinct().count() == len(set(keys)) == 13


def test_a_held_table_is_not_scanned_for_every_step(points, monkeypatch):
    monkeypatch.setattr(many_kmeans, "_scan", None)
    assert [m.k for m in many_kmeans.fit_many(points, [Model(2), Model(9)])] == [2, 9]


def test_fits_far_from_the_origin_are_exact():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) * 1e-3
    low, squares = x.astype(np.float32), (x * x).sum(axis=1)
    start = many_kmeans._spread_starts(x + 1e4, [7], [rng])[0] - 1e4
    centers, cost, _ = many_kmeans._fit_held(x, start, 100, 1e-9, low, squares)
    want, least = lloyd(x, start)
    assert np.allclose(centers, want, atol=1e-8) and cost == pytest.approx(least)


def test_guests_take_home_only_what_may_be_among_their_best():
    import pandas as pd

    x = np.random.default_rng(2).normal(size=(60, 4))
    d = np.linalg.norm(x[:, None] - x, axis=2)
    np.fill_diagonal(d, np.inf)
    hosts = [(h, g) for h in range(3) for g in range(h * 10, h * 10 + 40)]
    lists = pd.DataFrame({"host": [h for h, _ in hosts], "guest": [g for _, g in hosts], "fresh": True})
    far = np.where(np.arange(60) % 2, np.sort(d, axis=1)[:, 1], np.inf)
    vectors = pd.DataFrame({"idx": np.arange(60), "x": list(x), "far": far})
    found = descent._introductions(3)(lists, vectors)
    for g in range(60):
        with_ = sorted({b for h in range(3) for b in range(h * 10, h * 10 + 40) if h * 10 <= g < h * 10 + 40 and b != g}, key=lambda b: d[g, b])[:3]
        mine = found[found["src"] == g]
        assert mine["dst"].tolist() == [b for b in with_ if d[g, b] <= far[g] + 1e-9] and np.allclose(mine["d"], d[g, mine["dst"]])
