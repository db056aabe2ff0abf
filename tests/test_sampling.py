import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conceptlink.operators import features, sampling
from conceptlink.operators.ranking import exact_median, global_index, hash_rank, running_totals


def test_interval_sizes():
    assert sampling.interval_sizes(10, 3) == [4, 3, 3]
    assert sampling.interval_sizes(2, 3) == [1, 1, 0]


@pytest.mark.parametrize("n,k", [(10, 3), (7, 7), (100, 6), (3, 5)])
def test_near_equal_parts(spark, n, k):
    rows = sampling.near_equal_parts(spark.range(n).repartition(4), k, ["id"]).orderBy("id").collect()
    sizes = Counter(r["part"] for r in rows)
    assert [sizes[i] for i in range(k) if sizes[i]] == [s for s in sampling.interval_sizes(n, k) if s]
    assert [r["part"] for r in rows] == sorted(r["part"] for r in rows)


def test_subsample_is_exact_and_stable(spark):
    df = spark.range(1000)
    sizes = [sampling.subsample(df.repartition(p), 37, ["id"]).orderBy("id").collect() for p in (1, 9)]
    assert len(sizes[0]) == 37 and sizes[0] == sizes[1]
    assert sampling.subsample(df, 5000, ["id"]).count() == 1000


def test_hash_rank_is_a_dense_rank_per_group(spark):
    # one group holds most rows
    df = spark.range(900).withColumn("g", F.when(F.col("id") < 800, "hot").otherwise("cold"))
    rows = hash_rank(df, ["id"], 7, ["g"]).collect()
    for g, n in (("hot", 800), ("cold", 100)):
        assert sorted(r["rank"] for r in rows if r["g"] == g) == list(range(1, n + 1))
    top = hash_rank(df, ["id"], 7, ["g"], upto=5).collect()
    want = {(r["g"], r["id"]) for r in rows if r["rank"] <= 5}
    assert {(r["g"], r["id"]) for r in top} == want


def classes(spark):
    return spark.range(1000).withColumn("label", F.when(F.col("id") < 700, "a").when(F.col("id") < 950, "b").otherwise("c"))


def test_stratified_sample_sizes(spark):
    df = classes(spark)
    sizes = lambda s: {r["label"]: r["count"] for r in s.groupBy("label").count().collect()}
    assert sizes(sampling.stratified_sample(df, 101, ["id"])) == {"a": 71, "b": 25, "c": 5}
    assert sizes(sampling.stratified_sample(df, 100, ["id"], uniform=True)) == {"a": 34, "b": 33, "c": 33}
    assert sizes(sampling.stratified_sample(df, 5000, ["id"], replace=True)) == {"a": 3500, "b": 1250, "c": 250}
    assert sampling.stratified_sample(df, 10, ["id"], label=None).count() == 10


@pytest.mark.parametrize("n,want", [(100, {"x": 95, "y": 5}), (8, {"x": 4, "y": 4}), (11, {"x": 6, "y": 5}), (2000, {"x": 995, "y": 5})])
def test_uniform_parts_pass_on_what_small_classes_lack(spark, n, want):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 995, "x").otherwise("y"))
    drawn = sampling.stratified_sample(df, n, ["id"], uniform=True).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in drawn} == want


def test_long_draw_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_RUN", 7)
    df = classes(spark)
    again = sampling.stratified_sample(df, 100, ["id"], replace=True).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in again} == {"a": 70, "b": 25, "c": 5}


def test_running_totals_and_index_over_many_slices(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3).withColumn("v", (F.col("id") * 37) % 101).repartition(20)
    rows = running_totals(df, ["id"], {"v": "total"}, ["g"]).collect()
    for g in range(3):
        mine = sorted((r["id"], r["v"], r["total"]) for r in rows if r["g"] == g)
        acc = 0
        for _, v, total in mine:
            acc += v
            assert total == acc
    placed = global_index(df, [F.desc("id")], "at").collect()
    assert all(r["at"] == 499 - r["id"] for r in placed)


def test_exact_median(spark):
    values = [("a", float(v)) for v in (5, 1, 1, 9)] + [("b", 2.0)] + [("hot", float(i % 50)) for i in range(501)]
    df = spark.createDataFrame(values, "g string, v double").repartition(6)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    for g in ("a", "b", "hot"):
        assert got[g] == statistics.median(v for k, v in values if k == g)
    assert exact_median(df, [], "v").first()["median"] == statistics.median(v for _, v in values)


def test_exact_median_of_wide_and_repeated_values(spark):
    import random

    rnd = random.Random(3)
    values = [("wide", rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300)) for _ in range(2001)]
    values += [("even", rnd.gauss(0, 1)) for _ in range(3000)] + [("copies", 7.0)] * 4000 + [("copies", float(i)) for i in range(3000)]
    values += [("border", 1.0)] * 500 + [("border", 2.0)] * 500 + [("nulls", None), ("nulls", 3.0), ("none", None)]
    df = spark.createDataFrame(values, "g string, v double").repartition(6)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    want = {g: statistics.median(v for k, v in values if k == g and v is not None) for g in ("wide", "even", "copies", "border", "nulls")}
    assert got == want
    whole = df.selectExpr("cast(round(v) as long) as n").filter("abs(v) < 1e6")
    assert exact_median(whole, [], "n").first()["median"] == statistics.median(r["n"] for r in whole.collect())
    assert exact_median(df.limit(0), ["g"], "v").count() == 0


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    z = features.scale(df, ["a", "b"], "z").collect()
    assert [tuple(r) for r in z] == [(-1.0, 0.0), (1.0, 0.0)]
    m = features.scale(df, ["a", "b"], "minmax").collect()
    assert [tuple(r) for r in m] == [(0.0, 0.0), (1.0, 0.0)]
    n = features.scale(spark.createDataFrame([(3.0, -4.0), (0.0, 0.0)], "a double, b double"), ["a", "b"], "norm").collect()
    assert [tuple(r) for r in n] == [(0.6, -0.8), (0.0, 0.0)]
    fitted = features.fit_scaler(df, ["a"], "z")
    assert features.scale(spark.createDataFrame([(5.0,)], "a double"), ["a"], fitted).first()["a"] == 3.0
    assert features.scale(df, ["a"]).collect() == df.collect()
    with pytest.raises(ValueError):
        features.scale(df, ["a"], "odd")


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "y", "meta")], "id int, a double, b double, y string, m string")
    assert features.choose_columns(df, cols_y=["y"], untracked=["m", "id"]) == (["a", "b"], ["y"])
    assert features.choose_columns(df, cols_x=["a"], untracked=["m", "id"]) == (["a"], ["b", "y"])
    assert features.choose_columns(df, untracked=["m", "y", "id"]) == (["a", "b"], [])
    xy = features.to_features(df, cols_y=["y"], untracked=["m"], key=["id"])
    assert features.from_features(xy, ["a", "b"]).first().asDict() == {"id": 1, "y": "y", "a": 2.0, "b": 3.0}


def test_labels_and_noise(spark):
    df = spark.createDataFrame([(1, "p", 2.0), (2, "q", 0.5), (3, "p", -1.0)], "id int, y string, x double")
    encoded, sizes = features.encode_labels(df, "y", "p")
    assert [r["target"] for r in encoded.orderBy("id").collect()] == [1, 0, 1]
    assert {r["target"]: r["n"] for r in sizes.collect()} == {1: 2, 0: 1}
    noisy = features.perturb(df, ["x"], ["id"]).orderBy("id").collect()
    for before, after in zip((2.0, 0.5, -1.0), noisy):
        assert 0.5 / 1000 <= after["x"] - before <= 0.5 / 100
