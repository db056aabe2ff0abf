"""Vocabulary, frequencies, coverage, context windows and dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.functions import text as tx
from conceptlink.functions.stemming import stem
from conceptlink.operators.ranking import global_index
from conceptlink.operators.sampling import subsample
from conceptlink.operators.staging import written
from conceptlink.operators.vectors import in_blocks, text_sums, words_of_blocks


def exploded(df: DataFrame, words: Column, id_col: str = "doc_id", name: str = "token") -> DataFrame:
    """One row per word with its position."""
    return df.select(id_col, F.posexplode(words).alias("pos", name))


def vocabulary(words: DataFrame, word: str = "token") -> DataFrame:
    """Distinct words in order with a dense index from 0."""
    return global_index(words.select(word).distinct(), [word])


def frequencies(words: DataFrame, word: str = "token") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("freq"))


def most_common(counts: DataFrame, n: int, word: str = "token") -> DataFrame:
    return counts.orderBy(F.desc("freq"), word).limit(n)


def least_common(counts: DataFrame, n: int | None = None, word: str = "token") -> DataFrame:
    ordered = counts.orderBy("freq", word)
    return ordered if n is None else ordered.limit(n)


def most_and_least_common(counts: DataFrame, n: int = 10, word: str = "concept") -> DataFrame:
    top = most_common(counts, n, word).withColumn("side", F.lit("most"))
    return top.unionByName(least_common(counts, n, word).withColumn("side", F.lit("least")))


def _per_text(lists: DataFrame, vectors: DataFrame, words: str, *keys: str) -> DataFrame:
    """Words, words with a vector and the latter's share of each text."""
    counts = text_sums(lists, vectors, keys, words).drop("sums")
    return counts.withColumn("ratio", F.when(F.col("n_words") > 0, F.col("n_hit") / F.col("n_words")).otherwise(0.0))


def _distinct_words(lists: DataFrame, words: str) -> DataFrame:
    return lists.select(F.explode(words).alias("token")).dropna().distinct()


def _coverage(texts: DataFrame, distinct: DataFrame, vectors: DataFrame) -> DataFrame:
    """Report over the counts of each text and the distinct words."""
    known = vectors.select("token", F.lit(1).alias("hit"))
    by_text = texts.agg(
        F.avg("ratio").alias("mean_hit_ratio"),
        F.max("n_words").cast("double").alias("max_words"),
        F.min("n_words").cast("double").alias("min_words"),
        # list lengths are few distinct whole numbers, so the exact median's counts stay small
        F.median("n_words").cast("double").alias("median_words"),
        F.count_if(F.col("n_words") == 0).cast("double").alias("empty_texts"),
    )
    by_word = (
        distinct.join(known, "token", "left")
        .agg(
            F.count(F.lit(1)).cast("double").alias("unique_words"),
            F.count("hit").cast("double").alias("unique_known"),
        )
    )
    return metric_rows(by_text).unionByName(metric_rows(by_word))


def coverage(lists: DataFrame, vectors: DataFrame, words: str = "words", id_col: str = "doc_id") -> DataFrame:
    """Vector coverage of word lists as ``(metric, value)`` rows."""
    return _coverage(_per_text(lists, vectors, words, id_col), _distinct_words(lists, words), vectors)


def stemmed_coverage(lists: DataFrame, vectors: DataFrame, words: str = "words", id_col: str = "doc_id") -> DataFrame:
    """The same report over the stems of the words."""
    stems = written(stem_words(_distinct_words(lists, words)))
    # a word is known if its stem is, so the texts need not be rewritten
    known = stems.join(vectors.select(F.col("token").alias("stem")), "stem").select("token")
    return _coverage(_per_text(lists, known, words, id_col), stems.select(F.col("stem").alias("token")).distinct(), vectors)


def coverage_sketches(
    lists: DataFrame, vectors: DataFrame, part: str, words: str = "words", id_col: str = "doc_id", lg_k: int = 14, k: int = 800
) -> DataFrame:
    """Vector coverage of each ``part`` of the texts in a form that can be stored and merged.

    One row a part: part, texts, ratio_sum, max_words, min_words, empty_texts, and sketches of the texts' lengths (``lengths``), of
    the distinct words (``all_words``) and of those with a vector (``known_words``). New texts need only their own part's row,
    see ``sketched_coverage``. Distinct counts are off by about 1.04 / sqrt(2 ** ``lg_k``) (0.8 percent),
    ranks of lengths by well under one percent at the default ``k``. A null part is a part of its own.
    """
    texts = _per_text(lists, vectors, words, part, id_col).groupBy(part).agg(
        F.count(F.lit(1)).alias("texts"),
        F.sum("ratio").alias("ratio_sum"),
        F.max("n_words").alias("max_words"),
        F.min("n_words").alias("min_words"),
        F.count_if(F.col("n_words") == 0).alias("empty_texts"),
        F.kll_sketch_agg_bigint(F.col("n_words").cast("long"), k).alias("lengths"),
    )
    rows = lists.select(part, F.explode_outer(words).alias("token")).distinct()
    hit = rows.join(vectors.select("token", F.lit(1).alias("hit")), "token", "left")
    held = hit.groupBy(F.col(part).alias("_part")).agg(
        F.hll_sketch_agg("token", lg_k).alias("all_words"),
        F.hll_sketch_agg(F.when(F.col("hit").isNotNull(), F.col("token")), lg_k).alias("known_words"),
    )
    return texts.join(held, F.col(part).eqNullSafe(F.col("_part"))).drop("_part")


def sketched_coverage(sketches: DataFrame) -> DataFrame:
    """The report of ``coverage`` from the rows of any number of parts, whose texts differ; medians and distinct counts are estimates."""
    merged = sketches.agg(
        (F.sum("ratio_sum") / F.sum("texts")).alias("mean_hit_ratio"),
        F.max("max_words").alias("max_words"),
        F.min("min_words").alias("min_words"),
        F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("lengths"), F.lit(0.5)).alias("median_words"),
        F.sum("empty_texts").alias("empty_texts"),
        F.hll_sketch_estimate(F.hll_union_agg("all_words")).alias("unique_words"),
        F.hll_sketch_estimate(F.hll_union_agg("known_words")).alias("unique_known"),
    )
    return metric_rows(merged)


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A row of numbers as ``(metric, value)`` rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    )
    return one_row.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")


def inspection_sample(df: DataFrame, n: int = 20, id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    return subsample(df, n, [id_col], seed)


# --- stems ---------------------------------------------------------------------------


def stem_words(words: DataFrame, word: str = "token", out: str = "stem") -> DataFrame:
    """Stems of a word table; give it distinct words and join the result back."""
    return words.withColumn(out, stem(F.col(word)))


def stem_lists(lists: DataFrame, words: str = "words", id_col: str = "doc_id") -> DataFrame:
    """Stems of each text's words as ``(id, token)``; each distinct word is stemmed once.

    A text without words keeps one row with a null token.
    """
    rows = lists.select(id_col, F.explode_outer(words).alias("token"))
    stems = stem_words(rows.select("token").dropna().distinct())
    return rows.join(stems, "token", "left").select(id_col, F.col("stem").alias("token"))


# --- maps ----------------------------------------------------------------------------


def smallest_entries(df: DataFrame, entries: str, n: int = 15) -> DataFrame:
    """Entries of a map column by ascending value."""
    return df.select(F.explode(entries).alias("key", "value")).orderBy("value", "key").limit(n)


def flattened(df: DataFrame, nested: str) -> DataFrame:
    """Leaves of a map of maps as inner key and value; the outer key is dropped."""
    inner = df.select(F.explode(nested).alias("outer", "inner"))
    return inner.select(F.explode("inner").alias("key", "value"))


def leaf_count(df: DataFrame, nested: str) -> DataFrame:
    sizes = F.aggregate(F.map_values(nested), F.lit(0).cast("long"), lambda acc, m: acc + F.size(m))
    return df.agg(F.coalesce(F.sum(sizes), F.lit(0)).cast("long").alias("leaves"))


# --- context windows -----------------------------------------------------------------


def context_windows(df: DataFrame, words: Column, half: int, id_col: str = "doc_id") -> DataFrame:
    """Centre words with ``half`` words on both sides; edges without a full window give none."""
    listed = df.select(id_col, words.alias("_words"))
    last = F.size("_words") - half - 1
    places = F.when(last >= half, F.sequence(F.lit(half), last)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(
        places,
        lambda i: F.struct(
            i.alias("pos"),
            F.element_at("_words", i + 1).alias("center"),
            F.concat(F.slice("_words", i - half + 1, half), F.slice("_words", i + 2, half)).alias("context"),
        ),
    )
    return listed.select(id_col, F.explode(windows).alias("w")).select(id_col, "w.pos", "w.center", "w.context")


def word_rows(windows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sparse training rows: each window's context words with their share of the window.

    The shares are the non-zero entries of the mean of the context's one-hot vectors.
    """
    context = F.col("context")
    shares = F.transform(
        F.array_distinct(context),
        lambda t: F.struct(
            t.alias("token"), (F.size(F.filter(context, lambda c: c == t)) / F.size(context)).alias("share")
        ),
    )
    return windows.select(id_col, "pos", "center", F.explode(shares).alias("s")).select(
        id_col, "pos", "center", "s.token", "s.share"
    )


def _numbered(texts: pa.Table, known: pa.Table, keys: Sequence[str]) -> pa.Table:
    words = texts["_words"].combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    places = known["idx"].combine_chunks().take(pc.index_in(words.flatten(), known["token"].combine_chunks()))
    lists = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), places)
    return pa.table({**{k: texts[k] for k in keys}, "words": lists})


def numbered_words(lists: DataFrame, vocab: DataFrame, words: str = "words", id_col: str = "doc_id") -> DataFrame:
    """``(id, words)`` with each word's ``idx`` in the vocabulary in its place; null for words it lacks.

    Blocks of texts meet the numbers of their distinct words, so that a text is shuffled once and not word by word.
    """
    texts = in_blocks(lists.select(F.col(id_col).alias("_id"), F.col(words).alias("_words")), "_words")
    met = words_of_blocks(texts, "_words", vocab.select("token", F.col("idx").cast("long").alias("idx")))
    blocks = texts.groupBy("block").cogroup(met.groupBy("of"))
    schema = f"_id {dict(texts.dtypes)['_id']}, words array<long>"
    return blocks.applyInArrow(lambda a, b: _numbered(a, b, ["_id"]), schema).select(F.col("_id").alias(id_col), "words")


def training_examples(windows: DataFrame, vocab: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """Centre index and sparse context entries ``(idx, share)`` of every window; words the vocabulary lacks have none.

    Without ``vocab`` the windows are those of ``numbered_words`` and nothing is joined. With it, windows of words are
    joined with the vocabulary entry by entry.
    """
    rows = word_rows(windows, id_col)
    if vocab is None:
        rows = rows.filter("token is not null and center is not null")
        return rows.select(id_col, "pos", F.col("center").alias("center_idx"), F.col("token").alias("idx"), "share")
    centers = vocab.select(F.col("token").alias("center"), F.col("idx").alias("center_idx"))
    return rows.join(vocab, "token").join(centers, "center").select(id_col, "pos", "center_idx", "idx", "share")


def one_hot(words: DataFrame, vocab: DataFrame, word: str = "token") -> DataFrame:
    """Index of the single non-zero entry of each word's one-hot vector."""
    return words.join(vocab, word).withColumn("one", F.lit(1.0))


# --- vector lookup -------------------------------------------------------------------


def restrict_vectors(vectors: DataFrame, *word_sets: DataFrame) -> DataFrame:
    """Vectors of the words in the union of the given one-column word tables."""
    wanted = word_sets[0].toDF("token")
    for more in word_sets[1:]:
        wanted = wanted.union(more.toDF("token"))
    return vectors.join(wanted.distinct(), "token", "left_semi")


def vectors_in_order(vectors: DataFrame, words: DataFrame) -> DataFrame:
    """Vectors of ``(pos, token)`` rows, duplicates kept; a word without one fails the job."""
    found = words.join(vectors, "token", "left")
    present = F.assert_true(F.col("vec").isNotNull(), F.concat(F.lit("no vector for "), "token"))
    return found.filter(present.isNull()).orderBy("pos")


def translations(
    entries: DataFrame, words: DataFrame, vectors: DataFrame, overrides: DataFrame | None = None
) -> DataFrame:
    """Dictionary ``(source, target, vec)`` for the wanted words.

    Keys are capitalised, the first entry of a key wins, and each target takes
    its vector. ``overrides`` rows ``(source, target, vector_of)`` replace entries;
    one with a null target removes its key.
    """
    keyed = entries.withColumn("source", tx.capitalized(F.col("source")))
    wanted = keyed.join(words.toDF("source").distinct(), "source", "left_semi")
    # first row by file order, combined before the shuffle
    first = wanted.groupBy("source").agg(F.min_by("target", "entry").alias("target"))
    first = first.withColumn("vector_of", F.col("target"))
    if overrides is not None:
        first = first.join(overrides, "source", "left_anti").unionByName(overrides.filter("target is not null"))
    known = vectors.select(F.col("token").alias("vector_of"), "vec")
    return first.join(known, "vector_of").select("source", "target", "vec")


def mean_cluster_size(assignments: DataFrame) -> DataFrame:
    sizes = assignments.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.avg("n").alias("mean_size"))
