"""Density clusters over exact neighbour joins."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from conceptlink.operators.components import connected_components
from conceptlink.operators.neighbors import BLOCK, SLACK, _distances, _rows, build_cells, estimate_radius, kth_distance, meet, nearest, to_euclidean
from conceptlink.operators.ranking import global_index
from conceptlink.operators.staging import written

NOISE = -1


def _local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Component number of each column of a block's adjacency (rows link columns)."""
    roots = np.arange(adjacent.shape[1])
    while True:
        by_row = np.where(adjacent, roots, len(roots)).min(axis=1, initial=len(roots))
        by_column = np.where(adjacent, by_row[:, None], len(roots)).min(axis=0, initial=len(roots))
        lower = np.minimum(roots, by_column)
        if (lower == roots).all():
            return roots
        roots = lower


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lowest number that each of ``n`` numbers is linked to by the pairs (a, b)."""
    roots = np.arange(n)
    while True:
        x, y = roots[a], roots[b]
        lower = roots.copy()
        np.minimum.at(lower, np.maximum(x, y), np.minimum(x, y))
        while (lower[lower] != lower).any():
            lower = lower[lower]
        if (lower == roots).all():
            return roots
        roots = lower


def _joined_links(found: pd.DataFrame) -> pd.DataFrame:
    """Links of several blocks with one root for all that they join."""
    core = found["core"].to_numpy().astype(bool)
    ids, roots = found["id"].to_numpy(), found["root"].to_numpy()
    names, at = np.unique(np.concatenate([ids[core], roots]), return_inverse=True)
    a, b = at[: core.sum()], at[core.sum() :]
    lowest = _lowest(len(names), a, b[core])
    linked = np.flatnonzero(lowest != np.arange(len(names)))
    inner = pd.DataFrame({"id": names[linked], "core": True, "root": names[lowest[linked]]})
    border = pd.DataFrame({"id": ids[~core], "core": False, "root": names[lowest[b[~core]]]}).drop_duplicates()
    return pd.concat([inner, border], ignore_index=True)


def density_clusters(
    points: DataFrame, eps: float | None = None, min_points: int = 10, metric: str = "cosine", block: int = BLOCK
) -> DataFrame:
    """``(id, cluster_id, is_core)``: clusters by density, noise as -1.

    A row is core when at least ``min_points`` rows (itself included) lie within
    ``eps``; core rows within ``eps`` share a cluster; a border row joins the
    first cluster it touches. Neighbour counts and links leave a task as one row
    per input row, so a dense region does not turn into all its pairs. Clusters
    are numbered by their lowest core id; without ``eps`` it is estimated from a sample.
    """
    eps = estimate_radius(points, metric=metric) if eps is None else eps
    cells = build_cells(points, metric, block)
    kind = dict(points.dtypes)["id"]
    limit = to_euclidean(eps, metric)
    rows = cells.rows.withColumn("r", F.lit(limit))

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        near = _distances(_rows(a["x"]), _rows(b["x"])) <= limit + SLACK
        return pd.DataFrame({"id": a["id"], "n": near @ b["w"].to_numpy()})

    def added(found: pd.DataFrame) -> pd.DataFrame:
        return found.groupby("id", as_index=False, sort=False)["n"].sum()

    counted = meet(rows, cells.rows, cells, count, f"id {kind}, n long", block, added).groupBy("id").agg(F.sum("n").alias("n"))
    flagged = written(rows.join(counted, "id").withColumn("core", F.col("n") >= min_points).drop("n"))

    def link(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        near = _distances(_rows(a["x"]), _rows(b["x"])) <= limit + SLACK
        core = a["core"].to_numpy()
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        roots = _local_roots(near[core])
        names = np.empty(len(roots), dtype=others.dtype)
        for root in np.unique(roots):
            names[roots == root] = others[roots == root].min()
        touched = near[core].any(axis=1)
        first = near[core].argmax(axis=1)
        links = [(others, names), (ids[core][touched], names[first[touched]])]
        out = [pd.DataFrame({"id": i, "core": True, "root": r}) for i, r in links]
        i, j = np.nonzero(near[~core])
        edge = pd.DataFrame({"id": ids[~core][i], "core": False, "root": names[j]}).drop_duplicates()
        return pd.concat([*out, edge])

    residents = flagged.filter("core").drop("r", "core")
    links = written(meet(flagged, residents, cells, link, f"id {kind}, core boolean, root {kind}", block, _joined_links).distinct())
    cores = flagged.filter("core").select("id")
    edges = links.filter("core").select(F.col("id").alias("src"), F.col("root").alias("dst"))
    components = written(connected_components(cores, edges))
    border = (
        links.filter("not core")
        .join(components.withColumnRenamed("id", "root"), "root")
        .groupBy("id")
        .agg(F.min("component").alias("component"))
    )
    labelled = components.withColumn("is_core", F.lit(True)).unionByName(border.withColumn("is_core", F.lit(False)))
    numbers = global_index(components.select("component").distinct(), ["component"], "cluster_id")
    placed = labelled.join(numbers, "component").select("id", "cluster_id", "is_core")
    if cells.members is not None:
        placed = placed.withColumnRenamed("id", "rep").join(cells.members, "rep").drop("rep")
    full = points.select("id").join(placed, "id", "left")
    return full.select(
        "id",
        F.coalesce("cluster_id", F.lit(NOISE)).cast("long").alias("cluster_id"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"),
    )


def cluster_count(assignments: DataFrame) -> DataFrame:
    """Number of clusters, noise not counted."""
    return assignments.filter(F.col("cluster_id") != NOISE).agg(F.countDistinct("cluster_id").alias("n_clusters"))


def single_link(points: DataFrame, max_distance: float, k: int = 30, metric: str = "euclidean") -> DataFrame:
    """``(id, cluster_id)``: components of the k-nearest-neighbour graph cut at a distance."""
    edges = nearest(points, k, metric).filter(F.col("distance") <= max_distance).select("src", "dst")
    return connected_components(points, edges).withColumnRenamed("component", "cluster_id")


def reachability_edges(points: DataFrame, min_points: int, metric: str = "euclidean", neighbors: int | None = None) -> DataFrame:
    """Neighbour-graph edges weighted by mutual reachability, the larger of distance and both core distances.

    The graph links a row to its ``neighbors`` nearest ones, ``min_points`` if not given; the core distance is that to the ``min_points``-th.
    """
    near = written(nearest(points, max(min_points, neighbors or 0), metric))
    core = kth_distance(near, min_points)
    joined = near.join(core.toDF("src", "ca"), "src").join(core.toDF("dst", "cb"), "dst")
    return joined.select("src", "dst", F.greatest("distance", "ca", "cb").alias("reach"))


def density_levels(
    points: DataFrame,
    min_cluster_size: int = 10,
    min_points: int | None = None,
    shares: Sequence[float] = (0.25, 0.5, 0.75, 0.9),
    metric: str = "euclidean",
) -> DataFrame:
    """``(level, cut, id, cluster_id)``: density clusters at a ladder of reachability cuts.

    Each level keeps the edges up to a quantile of the reachability and the
    components of at least ``min_cluster_size`` rows; other rows are noise there.
    """
    edges = written(reachability_edges(points, min_points or min_cluster_size, metric))
    cuts = edges.approxQuantile("reach", list(shares), 0.001)
    levels = None
    for level, cut in enumerate(cuts):
        found = written(connected_components(points, edges.filter(F.col("reach") <= cut)))
        large = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_cluster_size)
        placed = found.join(large.select("component", F.col("component").alias("kept")), "component", "left")
        part = placed.select(
            F.lit(level).alias("level"), F.lit(float(cut)).alias("cut"), "id", F.coalesce("kept", F.lit(NOISE)).alias("cluster_id")
        )
        levels = part if levels is None else levels.unionByName(part)
    return levels


def flat_density_clusters(levels: DataFrame) -> DataFrame:
    """``(id, cluster_id)`` of the level with most clusters, the widest one on a tie."""
    counts = levels.filter(F.col("cluster_id") != NOISE).groupBy("level").agg(F.countDistinct("cluster_id").alias("n"))
    best = counts.orderBy(F.desc("n"), F.desc("level")).first()
    level = best["level"] if best else 0
    return levels.filter(F.col("level") == level).select("id", "cluster_id")
