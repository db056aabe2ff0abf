"""Positive and negative (document, concept) pairs with disjoint concept splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.functions import vec as vx
from conceptlink.functions.hashing import draw, order_key
from conceptlink.operators.ranking import global_index
from conceptlink.operators.sampling import bernoulli_split
from conceptlink.operators.staging import written


def concept_rows(docs: DataFrame, concepts: str = "concepts") -> DataFrame:
    """One row per document and listed concept, repeats kept."""
    return docs.select("doc_id", F.posexplode(concepts).alias("pos", "concept"))


def concept_universe(docs: DataFrame, concepts: str = "concepts") -> DataFrame:
    """All concepts of all lists with a dense index."""
    return global_index(docs.select(F.explode(concepts).alias("concept")).distinct(), ["concept"])


def drawn_negatives(doc_id: Column, own: Column, n: Column, size: int, seed: int) -> Column:
    """``n`` distinct concept indexes below ``size`` that are not in ``own``.

    Draws are hashed from the document key. Where they collide too often (a
    universe hardly larger than the list), a walk through the indexes from a
    hashed start finds the rest; it is long enough to succeed whenever enough
    other concepts exist, and the job fails when they do not.
    """
    draws = F.transform(
        F.sequence(F.lit(0), 2 * n + 3),
        lambda j: draw(order_key(seed, doc_id, j)) % size,
    )
    start = draw(order_key(seed, doc_id, F.lit("walk"))) % size
    walk = F.transform(
        F.sequence(F.lit(0), F.least(F.size(own) + 2 * n, F.lit(size - 1))),
        lambda t: (start + t) % size,
    )

    def picked(candidates: Column) -> Column:
        other = F.filter(candidates, lambda i: ~F.array_contains(own, i))
        return F.slice(F.array_distinct(other), F.lit(1), n)

    lucky = picked(draws)
    patient = picked(F.concat(draws, walk))
    enough = F.when(F.size(lucky) == n, lucky).when(F.size(patient) == n, patient)
    short = F.raise_error(F.lit("fewer other concepts than negatives asked for")).cast("array<bigint>")
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.coalesce(enough, short))


def _first_by_hash(items: Column, doc_id: Column, n: int | None, seed: int) -> Column:
    """``n`` random items of a list (all of them when ``n`` is None)."""
    if n is None:
        return items
    keyed = F.array_sort(F.transform(items, lambda i: F.struct(order_key(seed, doc_id, i).alias("k"), i.alias("i"))))
    return F.transform(F.slice(keyed, 1, n), lambda s: s["i"])


def positives(docs: DataFrame, n_per_text: int | None = None, seed: int = 7, concepts: str = "concepts") -> DataFrame:
    """``(doc_id, concept, label = 1)`` for a document's own concepts, repeats kept."""
    kept = _first_by_hash(F.col(concepts), F.col("doc_id"), n_per_text, seed)
    return docs.select("doc_id", F.explode(kept).alias("concept"), F.lit(1).alias("label"))


def indexed_lists(docs: DataFrame, universe: DataFrame, concepts: str = "concepts") -> DataFrame:
    """``(doc_id, own)``: the universe indexes of each document's list."""
    rows = concept_rows(docs, concepts).join(universe.select("concept", "idx"), "concept")
    return rows.groupBy("doc_id").agg(F.collect_list("idx").alias("own"))


def negatives(
    docs: DataFrame, universe: DataFrame, n_per_text: int | None = None, seed: int = 7, concepts: str = "concepts"
) -> DataFrame:
    """``(doc_id, concept, label = 0)``: as many other concepts per document as it lists."""
    size = universe.count()
    lists = indexed_lists(docs, universe, concepts)
    chosen = drawn_negatives(F.col("doc_id"), F.col("own"), F.size("own"), size, seed)
    chosen = _first_by_hash(chosen, F.col("doc_id"), n_per_text, seed)
    rows = lists.select("doc_id", F.explode(chosen).alias("idx"))
    return rows.join(universe.select("idx", "concept"), "idx").select("doc_id", "concept", F.lit(0).alias("label"))


def known_concepts(vectors: DataFrame) -> DataFrame:
    """Concepts with a non-zero vector."""
    return vectors.filter(~vx.is_zero(F.col("vec"))).select(F.col("token").alias("concept"))


def usable_documents(doc_vecs: DataFrame) -> DataFrame:
    return doc_vecs.filter(~vx.is_zero(F.col("vec"))).select("doc_id")


def tracked_concepts(train_pairs: DataFrame) -> DataFrame:
    """Concepts that occur as a training positive."""
    return train_pairs.filter("label = 1").select("concept").distinct()


def untracked_concepts(universe: DataFrame, tracked: DataFrame) -> DataFrame:
    return universe.select("concept").join(tracked, "concept", "left_anti")


def overlapping_concepts(tracked: DataFrame, untracked: DataFrame) -> DataFrame:
    """Rows here mean the two sets are not disjoint."""
    return tracked.select("concept").intersect(untracked.select("concept"))


def unseen_positives(test_positives: DataFrame, tracked: DataFrame) -> DataFrame:
    """Test positives whose concept was never a training positive."""
    return test_positives.join(tracked.select("concept"), "concept", "left_anti")


def skip_report(docs: DataFrame) -> DataFrame:
    """Documents, and those skipped for want of words or concepts."""
    skipped = (F.size("words") == 0) | (F.size("concepts") == 0)
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(skipped).alias("n_skipped"),
        F.avg(skipped.cast("double")).alias("skip_ratio"),
    )


def hit_report(pairs: DataFrame, usable: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs with (hits) and without (misses) both vectors."""
    docs = usable.withColumn("_d", F.lit(1))
    concepts = known.withColumn("_c", F.lit(1))
    flagged = pairs.join(docs, "doc_id", "left").join(concepts, "concept", "left")
    hit = F.col("_d").isNotNull() & F.col("_c").isNotNull()
    return flagged.agg(F.count_if(hit).alias("n_hit"), F.count_if(~hit).alias("n_missed"))


def build_pairs(
    docs: DataFrame,
    doc_vecs: DataFrame,
    vectors: DataFrame,
    train_size: float = 0.8,
    n_pos_per_text: int | None = None,
    n_neg_per_text: int | None = None,
    exclude_true_positives: bool = True,
    negatives_unseen_only: bool = False,
    test_unseen_concepts: bool = True,
    seed: int = 7,
) -> DataFrame:
    """Labelled ``(doc_id, concept, label, split)`` pairs; both halves of a pair have a vector.

    ``docs`` has ``doc_id, words, concepts``. Test positives are concepts that
    are no training positive. A document's own concepts are never its negatives;
    ``exclude_true_positives=False`` only protects the positives left in the test
    split, and ``negatives_unseen_only`` draws test negatives from concepts
    that are no training positive.
    """
    used = docs.filter((F.size("words") > 0) & (F.size("concepts") > 0)).select("doc_id", "concepts")
    used = bernoulli_split(used, train_size, ["doc_id"], seed)
    universe = written(concept_universe(docs))
    size = universe.count()

    own = indexed_lists(used, universe).join(used.select("doc_id", "split"), "doc_id")
    usable = usable_documents(doc_vecs).withColumn("usable", F.lit(True))
    own = written(own.join(usable, "doc_id", "left").withColumn("usable", F.col("usable").isNotNull()))
    known = universe.join(known_concepts(vectors), "concept", "left_semi").select("idx", "concept")

    def rows(df: DataFrame, items: Column, label: int, split: str) -> DataFrame:
        return df.select("doc_id", F.explode(items).alias("idx"), F.lit(label).alias("label"), F.lit(split).alias("split"))

    doc = F.col("doc_id")
    train = own.filter("split = 'train' and usable")
    train_neg = drawn_negatives(doc, F.col("own"), F.size("own"), size, seed)
    train_rows = rows(train, _first_by_hash(F.col("own"), doc, n_pos_per_text, seed), 1, "train").unionByName(
        rows(train, _first_by_hash(train_neg, doc, n_neg_per_text, seed), 0, "train")
    )
    train_pairs = train_rows.join(known, "idx")
    # the test split depends on this table, so it is written rather than computed twice
    tracked = written(train_pairs.filter("label = 1").select("idx", "concept").distinct())

    test = own.filter("split = 'test' and usable")
    left = test.select("doc_id", "own", F.explode(F.array_distinct("own")).alias("idx"))
    if test_unseen_concepts:
        left = left.join(tracked.select("idx"), "idx", "left_anti")
    left = left.groupBy("doc_id").agg(F.collect_list("idx").alias("rest"), F.first("own").alias("own"))
    rest = F.array_sort("rest")
    n = F.size("rest")
    barred = F.col("own") if exclude_true_positives else F.col("rest")
    test_pos = rows(left, _first_by_hash(rest, doc, n_pos_per_text, seed), 1, "test").join(known, "idx")
    if negatives_unseen_only:
        fresh = written(global_index(universe.join(tracked.select("concept"), "concept", "left_anti").drop("idx"), ["concept"]))
        # barred concepts in the index of the smaller universe
        translate = left.select("doc_id", F.explode(barred).alias("_old"))
        translate = translate.join(universe.select(F.col("idx").alias("_old"), "concept"), "_old").join(fresh, "concept")
        translate = translate.groupBy("doc_id").agg(F.collect_list("idx").alias("barred"))
        drawn = left.select("doc_id", "rest").join(translate, "doc_id", "left")
        barred = F.coalesce("barred", F.array().cast("array<bigint>"))
        items = drawn_negatives(doc, barred, n, fresh.count(), seed)
        lookup = fresh.join(known.select("concept"), "concept", "left_semi").select("idx", "concept")
        test_neg = rows(drawn, _first_by_hash(items, doc, n_neg_per_text, seed), 0, "test").join(lookup, "idx")
    else:
        items = drawn_negatives(doc, barred, n, size, seed)
        test_neg = rows(left, _first_by_hash(items, doc, n_neg_per_text, seed), 0, "test").join(known, "idx")
    return train_pairs.unionByName(test_pos).unionByName(test_neg).select("doc_id", "concept", "label", "split")
