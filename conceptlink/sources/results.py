"""Cluster results: writing them and putting them back on the document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptlink.sources.tables import write_csv


def tagged_assignments(assignments: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """``(id, cluster_id[, label[, tag]])``; tags are looked up by label."""
    if tags is None:
        return assignments
    return assignments.join(tags, "label", "left").select(*assignments.columns, "tag")


def neighbor_lists(topk: DataFrame) -> DataFrame:
    """Cluster to its comma-joined top members; a list is as long as the k of the top-k."""
    members = F.array_sort(F.collect_list(F.struct("rank", F.col("id").cast("string").alias("id"))))
    joined = F.concat_ws(",", F.transform(members, lambda m: m["id"]))
    return topk.groupBy("cluster_id").agg(joined.alias("knn"))


def save_clusters(
    assignments: DataFrame, topk: DataFrame, path: str, identifier: str, tags: DataFrame | None = None
) -> None:
    write_csv(tagged_assignments(assignments, tags), f"{path}/cluster_id-{identifier}.csv")
    write_csv(neighbor_lists(topk), f"{path}/cluster_knnmap-{identifier}.csv", sep="|")


def load_clusters(spark: SparkSession, path: str, identifier: str, points: DataFrame) -> DataFrame:
    """Saved cluster ids joined to ``points`` by id; fails unless every point has one."""
    saved = spark.read.csv(f"{path}/cluster_id-{identifier}.csv", header=True)
    saved = saved.select(F.col("id").cast("long").alias("id"), F.col("cluster_id").cast("int").alias("cluster_id"))
    joined = points.join(saved, "id", "left")
    known = F.assert_true(F.col("cluster_id").isNotNull(), F.lit("a row has no saved cluster"))
    return joined.filter(known.isNull())


def with_cluster_ids(documents: DataFrame, assignments: DataFrame) -> DataFrame:
    """Documents with their cluster id (null where they have none), matched by ``doc_id``."""
    return documents.join(assignments.select("doc_id", "cluster_id"), "doc_id", "left")
