"""Sampling and splitting by hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from conceptlink.functions.hashing import below, draw, order_key
from conceptlink.operators.ranking import global_index, hash_rank


DRAW_RUN = 100_000


def subsample(df: DataFrame, n: int, id_cols: Sequence[str], seed: int = 7) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows when there are fewer)."""
    return hash_rank(df, id_cols, seed, upto=n).drop("rank")


def shuffled(df: DataFrame, id_cols: Sequence[str], seed: int = 7) -> DataFrame:
    """All rows in hash order, as a distributed sort."""
    return df.orderBy(order_key(seed, *id_cols), *id_cols)


def bernoulli_split(df: DataFrame, train_size: float, id_cols: Sequence[str], seed: int = 7) -> DataFrame:
    """Add ``split``: 'train' for about ``train_size`` of the keys, else 'test'."""
    in_train = below(order_key(seed, *id_cols), train_size)
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def class_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_quotas(df: DataFrame, label: str, n: int, uniform: bool = False, replace: bool = False) -> DataFrame:
    """Rows to draw per class, summing to ``n``.

    Proportional: floors first, the rest to the largest fractions. Uniform:
    near-equal parts, larger ones first; unless drawing with replacement, a class
    smaller than its part gives all its rows and the others share the rest.
    Holds one row per class.
    """
    sizes = class_sizes(df, label).withColumnRenamed("n", "size")
    everything = Window.partitionBy()
    if uniform:
        # in order of size, a class gives all its rows as long as giving as many from all larger ones does not pass n
        upto = Window.orderBy("size", label).rowsBetween(Window.unboundedPreceding, 0)
        k = F.count(F.lit(1)).over(everything)
        larger = k - F.count(F.lit(1)).over(upto)
        whole = F.lit(False) if replace else F.sum("size").over(upto) + F.col("size") * larger <= n
        sizes = sizes.withColumn("_whole", whole)
        shared = Window.partitionBy("_whole")
        rest = F.lit(n) - F.coalesce(F.sum(F.when(F.col("_whole"), F.col("size"))).over(everything), F.lit(0))
        sizes = sizes.withColumn("_rest", rest).withColumn("_k", F.count(F.lit(1)).over(shared))
        place = F.row_number().over(shared.orderBy(label))
        part = F.expr("_rest div _k") + F.when(place <= F.col("_rest") % F.col("_k"), 1).otherwise(0)
        return sizes.select(label, "size", F.when(F.col("_whole"), F.col("size")).otherwise(part).cast("long").alias("quota"))
    total = F.sum("size").over(everything)
    sizes = sizes.withColumn("_scaled", F.col("size") * F.lit(n)).withColumn("_total", total)
    sizes = sizes.withColumn("_floor", F.expr("_scaled div _total")).withColumn("_rest", F.expr("_scaled % _total"))
    left = F.lit(n) - F.sum("_floor").over(everything)
    place = F.row_number().over(Window.orderBy(F.desc("_rest"), label))
    quota = F.col("_floor") + F.when(place <= left, 1).otherwise(0)
    return sizes.withColumn("quota", quota.cast("long")).select(label, "size", "quota")


def stratified_sample(
    df: DataFrame,
    n: int,
    id_cols: Sequence[str],
    label: str | None = "label",
    uniform: bool = False,
    replace: bool = False,
    seed: int = 7,
) -> DataFrame:
    """Sample ``n`` rows by class; without a label a plain sample.

    With replacement each class quota is a list of hashed draws over the class
    positions, so drawing never gathers a class. Without replacement a table of
    fewer than ``n`` rows comes back whole.
    """
    if label is None:
        return subsample(df, n, id_cols, seed)
    quotas = class_quotas(df, label, n, uniform, replace)
    if not replace:
        placed = df.join(quotas.drop("size"), label)
        return hash_rank(placed, id_cols, seed, [label], upto=F.col("quota")).drop("quota", "rank")
    # a large quota is cut into short runs of draws, so no row carries a long list
    runs = quotas.filter("quota > 0").select(label, "size", "quota", F.explode(F.sequence(F.lit(1), F.col("quota"), F.lit(DRAW_RUN))).alias("first"))
    last = F.least(F.col("first") + DRAW_RUN - 1, F.col("quota"))
    draws = runs.select(label, "size", F.explode(F.sequence("first", last)).alias("draw"))
    draws = draws.withColumn("rank", draw(order_key(seed, label, "draw")) % F.col("size") + 1).drop("size")
    return hash_rank(df, id_cols, seed, [label]).join(draws, [label, "rank"]).drop("rank")


def cluster_sample(df: DataFrame, id_cols: Sequence[str], n: int | None = None, seed: int = 7) -> DataFrame:
    """Sample by cluster id, a tenth of the rows unless ``n`` is given."""
    n = n or max(1, df.count() // 10)
    return stratified_sample(df, n, id_cols, "cluster_id", seed=seed)


def near_equal_parts(df: DataFrame, k: int, order: Sequence[str], name: str = "part") -> DataFrame:
    """Cut the ordered rows into ``k`` near-equal parts, larger parts first."""
    placed = global_index(df, order, "_idx")
    n = placed.count()
    size, larger = divmod(n, k)
    edge = larger * (size + 1)
    head = F.expr(f"_idx div {size + 1}")
    tail = F.expr(f"{larger} + (_idx - {edge}) div {max(size, 1)}")
    return placed.withColumn(name, F.when(F.col("_idx") < edge, head).otherwise(tail)).drop("_idx")


def interval_sizes(total: int, parts: int) -> list[int]:
    """Sizes of ``parts`` near-equal parts of ``total``, larger ones first."""
    size, larger = divmod(total, parts)
    return [size + (i < larger) for i in range(parts)]
