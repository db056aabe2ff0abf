"""Cluster, score, describe and store: the whole analysis of a point table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from conceptlink.operators import clustering, density, summaries
from conceptlink.operators.neighbors import local_affinity, nearest
from conceptlink.operators.sampling import subsample
from conceptlink.operators.staging import written
from conceptlink.sources.results import save_clusters

METHODS: dict[str, Callable[..., DataFrame]] = {
    "kmeans": lambda p, k: clustering.kmeans(p, k),
    "minibatch": lambda p, k: clustering.minibatch_kmeans(p, k),
    "spectral": lambda p, k: clustering.spectral_clusters(p, k),
    "agglomerative": lambda p, k: clustering.bisecting(p, k),
    "dbscan": lambda p, k: density.density_clusters(p),
    "hdbscan": lambda p, k: density.flat_density_clusters(density.density_levels(p, 20)),
}


@dataclass(frozen=True)
class Analysis:
    assignments: DataFrame  # id, vec, cluster_id[, label]
    metrics: DataFrame  # metric, value
    centers: DataFrame  # cluster_id, center, size
    top: DataFrame  # cluster_id, rank, id, distance
    distribution: DataFrame | None  # cluster_id, label, n, share


def cluster_with(points: DataFrame, method: str, k: int, optimize_k: bool = False) -> DataFrame:
    """``points`` with the ``cluster_id`` of the named method."""
    if method not in METHODS:
        raise NotImplementedError(f"unknown method: {method}")
    if optimize_k and method == "kmeans":
        k, _, _ = clustering.choose_k(points)
    labelled = METHODS[method](points.drop("cluster_id"), k)
    return clustering.with_noise(points.drop("cluster_id"), labelled)


def analyze(
    points: DataFrame,
    method: str | None = "kmeans",
    k: int = 5,
    top_k: int = 10,
    labelled: bool = False,
    silhouette_sample: int | None = None,
    path: str | None = None,
    identifier: str = "clusters",
    tags: DataFrame | None = None,
    optimize_k: bool = False,
) -> Analysis:
    """Fit (or, with ``method=None``, reuse the ``cluster_id`` of) a clustering and report on it.

    Rows that the clustering leaves out are noise, -1; the metrics treat noise as one more cluster.
    """
    placed = written(points if method is None else cluster_with(points, method, k, optimize_k))
    metrics = summaries.metric_rows(summaries.silhouette_score(placed, silhouette_sample))
    if labelled:
        metrics = metrics.unionByName(summaries.external_metrics(placed))
    centers = written(summaries.cluster_means(placed))
    top = summaries.top_members(placed, top_k, centers)
    if path:
        columns = ["id", "cluster_id", *(["label"] if labelled else [])]
        save_clusters(placed.select(*columns), top, path, identifier, tags)
    distribution = summaries.label_distribution(placed) if labelled else None
    return Analysis(placed, metrics, centers, top, distribution)


def cluster_documents(
    doc_vecs: DataFrame,
    k: int = 10,
    components: int = 10,
    method: str = "default",
    min_cluster_size: int = 20,
    seed: int = 7,
    sample: int | None = None,
    most_clusters: int | None = None,
) -> tuple[DataFrame, Analysis]:
    """Cluster ids of document vectors, and the analysis of their spectral clustering.

    The default method is k-means on leading principal components; 'density'
    keeps the best level of density clusters. The number of spectral clusters
    comes from the eigengap, at most ``most_clusters`` when given. ``sample`` limits the spectral stage to that many rows;
    without it all rows take part.
    """
    points = written(doc_vecs.select(F.col("doc_id").alias("id"), "vec"))
    if method.startswith("den"):
        flat = density.flat_density_clusters(density.density_levels(points, min_cluster_size))
        ids = flat.select(F.col("id").alias("doc_id"), "cluster_id")
    else:
        placed = clustering.projected_kmeans(points, k, components, seed=seed, stored=True)
        ids = placed.select(F.col("id").alias("doc_id"), "cluster_id")
    chosen = points if sample is None else written(subsample(points, sample, ["id"], seed))
    affinity = written(local_affinity(nearest(chosen, 10), 10))
    counts = clustering.suggested_counts(clustering.eigengap(affinity))
    n = max(2, *counts) if most_clusters is None else max(2, min(max(counts), most_clusters))
    found = clustering.with_noise(chosen, clustering.spectral(affinity, n))
    return written(ids), analyze(found, method=None)
