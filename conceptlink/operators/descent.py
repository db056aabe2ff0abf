"""Neighbour graphs by neighbour descent: near-linear work where distance bounds cut nothing.

A neighbour of a neighbour is likely a neighbour. Every round, each row introduces the
rows of its current list, and those that list it, to each other, and every row
keeps the nearest it has met. Rows are numbered so that rows of one cell
stand together and go to slots of bounded size; the graph itself holds only numbers and
distances, and a vector travels once to each slot that asks for it. The result
is approximate: tests measure its recall against the exact join
(``neighbors.nearest``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from conceptlink.operators.neighbors import _distances, _rows, _spread_neighbors, build_cells, from_euclidean
from conceptlink.operators.ranking import global_index
from conceptlink.operators.staging import written

SLOT = 256  # rows whose lists are handled together
RANDOM_LINKS = 2  # links across the whole table that each row starts with
GRAPH = "src long, dst long, d double"
ROUNDING = 1e-6  # by which a distance may differ in another product


def _best(links: DataFrame, k: int) -> DataFrame:
    """The k nearest links of every row; a link that was there before stays old."""
    folded = links.groupBy("src", "dst").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("src").orderBy("d", "dst")
    return folded.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _sampled(links: DataFrame, size: int, seed: int) -> DataFrame:
    """At most ``size`` links of each row and freshness, in hash order."""
    w = Window.partitionBy("host", "fresh").orderBy(F.xxhash64(F.lit(seed), "host", "guest"), "guest")
    return links.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= size).drop("_at")


def _slot_mates(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of the same slot."""

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = _rows(pdf["x"]), pdf["idx"].to_numpy()
        d = _distances(x, x)
        np.fill_diagonal(d, np.inf)
        return _nearest_of(ids, ids, d, k)

    return rows.groupBy("slot").applyInPandas(near, GRAPH)


def _nearest_of(ids: np.ndarray, others: np.ndarray, d: np.ndarray, k: int) -> pd.DataFrame:
    """The finite ones among the k smallest entries of each row of ``d``."""
    width = min(k, d.shape[1])
    at = np.argpartition(d, width - 1, axis=1)[:, :width] if width < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(d), 1))
    value = np.take_along_axis(d, at, axis=1)
    keep = np.isfinite(value)
    return pd.DataFrame({"src": np.repeat(ids, keep.sum(axis=1)), "dst": others[at][keep], "d": value[keep]})


def _introductions(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Let the guests of each host of a slot meet; pairs of two old guests have met before.

    A guest takes home the ``k`` nearest it has met in the slot, none beyond ``far``, its k-th nearest so far: no others can be among its best.
    """

    def meet(lists: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if lists.empty:
            return pd.DataFrame({"src": [], "dst": [], "d": []})
        order = np.argsort(vectors["idx"].to_numpy())
        known, x, far = vectors["idx"].to_numpy()[order], _rows(vectors["x"])[order], vectors["far"].to_numpy()[order]
        by_host = np.argsort(lists["host"].to_numpy(), kind="stable")
        host, guest, fresh_ = (lists[c].to_numpy()[by_host] for c in ("host", "guest", "fresh"))
        place = np.searchsorted(known, guest)
        found = []
        for at in np.split(np.arange(len(host)), np.flatnonzero(np.diff(host)) + 1):
            ids, fresh, rows = guest[at], fresh_[at], x[place[at]]
            d = _distances(rows, rows)
            d[~(fresh[:, None] | fresh[None, :])] = np.inf
            d[d > far[place[at]][:, None] + ROUNDING * (1 + d)] = np.inf
            np.fill_diagonal(d, np.inf)
            found.append(_nearest_of(ids, ids, d, k))
        src, dst, d = (np.concatenate([f[c].to_numpy() for f in found]) for c in ("src", "dst", "d"))
        order = np.lexsort((dst, src))
        src, dst, d = src[order], dst[order], d[order]
        first = np.flatnonzero((np.diff(src, prepend=-1) != 0) | (np.diff(dst, prepend=-1) != 0))
        src, dst, d = src[first], dst[first], np.minimum.reduceat(d, first) if len(first) else d
        order = np.lexsort((dst, d, src))
        src, dst, d = src[order], dst[order], d[order]
        best = np.arange(len(src)) - np.searchsorted(src, src) < k
        return pd.DataFrame({"src": src[best], "dst": dst[best], "d": d[best]})

    return meet


def descend(rows: DataFrame, k: int, least_change: float, rounds: int, seed: int) -> DataFrame:
    """``(src, dst, d, rank)`` between rows ``(idx, slot, x)`` numbered densely from 0.

    Stops when a round changes at most ``least_change`` of all links.
    """
    n = rows.count()
    jump = F.pmod(F.xxhash64(F.lit(seed), "idx", "j"), F.lit(max(n - 1, 1))) + 1
    far = rows.select("idx", "slot", F.explode(F.sequence(F.lit(0), F.lit(RANDOM_LINKS - 1))).alias("j"))
    far = far.select(F.col("idx").alias("src"), F.pmod(F.col("idx") + jump, F.lit(n)).alias("dst"), F.lit(float("inf")).alias("d"))
    start = _slot_mates(rows, k).unionByName(far.filter("src <> dst")).withColumn("fresh", F.lit(True))
    # random links are as far as can be until their ends are measured, so they never push out a measured one but at the rank kept for them
    graph = written(_best(start, k + RANDOM_LINKS))
    for turn in range(rounds):
        ahead = graph.select(F.col("src").alias("host"), F.col("dst").alias("guest"), "fresh")
        taken = _sampled(ahead, k, seed + turn)
        back = _sampled(taken.select(F.col("guest").alias("host"), F.col("host").alias("guest"), "fresh"), k, seed + turn)
        reach = graph.filter(F.col("rank") == k).select(F.col("src").alias("idx"), F.col("d").alias("far"))
        vectors = rows.select("idx", "x").join(reach, "idx", "left").withColumn("far", F.coalesce("far", F.lit(float("inf"))))
        itself = rows.select(F.col("idx").alias("host"), F.col("idx").alias("guest"), F.lit(True).alias("fresh"))
        guests = taken.unionByName(back).unionByName(itself).groupBy("host", "guest").agg(F.max("fresh").alias("fresh"))
        lists = written(guests.withColumn("slot", F.floor(F.col("host") / SLOT)))
        wanted = lists.select(F.col("slot").alias("asker"), F.col("guest").alias("idx")).distinct().join(vectors, "idx")
        met = lists.groupBy("slot").cogroup(wanted.groupBy("asker")).applyInPandas(_introductions(k), GRAPH)
        # what was sampled has now been introduced; the other fresh links wait for a later round
        done = taken.select(F.col("host").alias("src"), F.col("guest").alias("dst"), F.lit(True).alias("_done"))
        kept = graph.join(done, ["src", "dst"], "left").select("src", "dst", "d", (F.col("fresh") & F.col("_done").isNull()).alias("fresh"))
        graph = written(_best(kept.unionByName(met.withColumn("fresh", F.lit(True))), k))
        if graph.filter("fresh").count() <= least_change * n * k:
            break
    return graph.filter(F.col("d") < float("inf")).select("src", "dst", "d", "rank")


def descent_neighbors(
    points: DataFrame,
    k: int,
    metric: str = "euclidean",
    width: int | None = None,
    least_change: float = 0.002,
    rounds: int = 30,
    seed: int = 7,
) -> DataFrame:
    """``(src, dst, distance, rank)``: approximately the k nearest other rows of every row, ties by id.

    Equal vectors are folded first, so a large group of copies costs one row. The search works on lists of
    ``width`` rows (``2 k`` by default) and cuts them to ``k`` in the end: wider lists find more and cost more. At most ``width`` fresh
    and old rows of a list, and as many that list the row, meet in a round; the rest wait for later rounds. Under
    the cosine metric all-zero vectors are left out.
    """
    width = max(k, width or 2 * k)
    cells = build_cells(points, metric, SLOT, seed)
    numbered = written(global_index(cells.rows.select("id", "home", "reach", "x"), ["home", "reach", "id"]))
    rows = written(numbered.select("idx", F.floor(F.col("idx") / SLOT).alias("slot"), "x"))
    graph = descend(rows, width, least_change, rounds, seed)
    names = numbered.select("idx", "id")
    named = graph.join(names.toDF("src", "a"), "src").join(names.toDF("dst", "b"), "dst")
    w = Window.partitionBy("src").orderBy("d", "dst")
    best = named.select(F.col("a").alias("src"), F.col("b").alias("dst"), "d").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    if cells.members is not None:
        best = _spread_neighbors(written(best), cells.members, k)
    return best.select("src", "dst", from_euclidean(F.col("d"), metric).alias("distance"), "rank")
