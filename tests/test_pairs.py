from collections import Counter

import pytest
from pyspark.sql import functions as F

from conceptlink.operators import pairs, sampling
from conceptlink.operators.vectors import doc_vectors


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, ["w"], [f"c{i % 7}", f"c{(i * 3 + 1) % 11}", f"k{i % 5}"]) for i in range(60)]
    rows += [(100, [], ["c1"]), (101, ["w"], []), (102, ["unknown"], ["c2"]), (103, ["w"], ["c1", "c1", "c3"])]
    return spark.createDataFrame(rows, "doc_id long, words array<string>, concepts array<string>")


@pytest.fixture(scope="module")
def vectors(spark):
    names = [f"c{i}" for i in range(11)] + [f"k{i}" for i in range(4)]  # k4 has none
    rows = [(n, [1.0, float(i)]) for i, n in enumerate(names)] + [("w", [2.0, 1.0])]
    return spark.createDataFrame(rows, "token string, vec array<float>")


def test_negatives_are_others_and_as_many(docs):
    listed = docs.filter(F.size("concepts") > 0)
    universe = pairs.concept_universe(docs)
    rows = pairs.negatives(listed, universe).collect()
    own = {r["doc_id"]: r["concepts"] for r in listed.collect()}
    drawn = {}
    for r in rows:
        drawn.setdefault(r["doc_id"], []).append(r["concept"])
    assert set(drawn) == set(own)
    for doc, names in drawn.items():
        assert len(names) == len(set(names)) == len(own[doc])
        assert not set(names) & set(own[doc])


def test_negatives_fill_up_from_a_tiny_universe(spark):
    # 3 own concepts and exactly 3 others
    df = spark.createDataFrame([(i, ["a", "b", "c"]) for i in range(40)] + [(99, ["d", "e", "f"])], "doc_id long, concepts array<string>")
    rows = pairs.negatives(df, pairs.concept_universe(df)).filter("doc_id < 99").collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["concept"])
    assert all(names == {"d", "e", "f"} for names in got.values()) and len(got) == 40


def test_too_few_other_concepts_is_an_error(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "doc_id long, concepts array<string>")
    with pytest.raises(Exception, match="fewer other concepts"):
        pairs.negatives(df, pairs.concept_universe(df)).collect()


def test_draws_do_not_depend_on_partitioning(docs):
    listed = docs.filter(F.size("concepts") > 0)
    results = []
    for parts in (1, 8, 50):
        spread = listed.repartition(parts)
        rows = pairs.negatives(spread, pairs.concept_universe(spread)).collect()
        results.append(sorted((r["doc_id"], r["concept"]) for r in rows))
    assert results[0] == results[1] == results[2]


def test_draws_are_even(spark):
    df = spark.createDataFrame([(i, ["own"]) for i in range(4000)] + [(9999, [f"x{i}" for i in range(10)])], "doc_id long, concepts array<string>")
    rows = pairs.negatives(df, pairs.concept_universe(df)).filter("doc_id < 9999").groupBy("concept").count().collect()
    counts = [r["count"] for r in rows]
    assert len(counts) == 10 and min(counts) > 320 and max(counts) < 480


def build(docs, vectors, **settings):
    return pairs.build_pairs(docs, doc_vectors(docs, vectors), vectors, train_size=0.6, **settings).collect()


def test_built_pairs(docs, vectors):
    rows = build(docs, vectors)
    own = {r["doc_id"]: r["concepts"] for r in docs.collect()}
    train_pos = {r["concept"] for r in rows if r["split"] == "train" and r["label"] == 1}
    test_pos = {r["concept"] for r in rows if r["split"] == "test" and r["label"] == 1}
    assert train_pos and not train_pos & test_pos
    for r in rows:
        assert (r["concept"] in own[r["doc_id"]]) == (r["label"] == 1)
        assert r["concept"] != "k4"
    # no words, no concepts, no known words
    assert not {100, 101, 102} & {r["doc_id"] for r in rows}
    split = {r["doc_id"]: r["split"] for r in rows}
    if split.get(103) == "train":
        repeated = Counter((r["concept"], r["label"]) for r in rows if r["doc_id"] == 103)
        assert repeated[("c1", 1)] == 2


def test_seen_test_concepts_on_request(docs, vectors):
    rows = build(docs, vectors, test_unseen_concepts=False)
    train_pos = {r["concept"] for r in rows if r["split"] == "train" and r["label"] == 1}
    test_pos = {r["concept"] for r in rows if r["split"] == "test" and r["label"] == 1}
    assert train_pos & test_pos


def test_caps_and_unseen_negatives(docs, vectors):
    rows = build(docs, vectors, n_pos_per_text=1, n_neg_per_text=1, negatives_unseen_only=True)
    per_doc = Counter((r["doc_id"], r["label"]) for r in rows)
    assert max(per_doc.values()) == 1
    train_pos = {r["concept"] for r in rows if r["split"] == "train" and r["label"] == 1}
    test_neg = {r["concept"] for r in rows if r["split"] == "test" and r["label"] == 0}
    assert not train_pos & test_neg


def test_tracked_and_untracked_are_disjoint(docs):
    universe = pairs.concept_universe(docs)
    tracked = pairs.tracked_concepts(pairs.positives(docs.filter("doc_id < 3")))
    rest = pairs.untracked_concepts(universe, tracked)
    assert pairs.overlapping_concepts(tracked, rest).count() == 0
    assert tracked.count() + rest.count() == universe.count()


def test_skip_and_hit_reports(spark, docs, vectors):
    report = pairs.skip_report(docs).first()
    assert (report["n_docs"], report["n_skipped"]) == (64, 2)
    usable = pairs.usable_documents(doc_vectors(docs, vectors))
    hits = pairs.hit_report(pairs.positives(docs), usable, pairs.known_concepts(vectors)).first()
    assert hits["n_hit"] + hits["n_missed"] == docs.select(F.explode("concepts")).count()


def test_bernoulli_split_is_stable_and_near_its_share(spark):
    df = spark.range(5000)
    a = sampling.bernoulli_split(df, 0.6, ["id"])
    b = sampling.bernoulli_split(df.repartition(13), 0.6, ["id"])
    assert a.exceptAll(b).count() == 0
    assert abs(a.filter("split = 'train'").count() / 5000 - 0.6) < 0.03
