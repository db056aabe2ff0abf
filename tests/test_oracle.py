"""Every query next to its SQL twin on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point

TINY = "/root/testdata/sf0.001"
# trained jobs take minutes together and have tests of their own
SLOW = {
    "chosen_cluster_count", "cluster_analysis_report", "cross_validation_report", "density_hierarchy_clusters", "document_cluster_sizes",
    "forest_report", "gap_statistics", "laplacian_eigengaps", "logistic_report", "multi_level_density_clusters",
    "network_training_curve", "projected_kmeans_clusters", "silhouette_scan", "smallest_laplacian_eigenvalues", "spectral_clusters", "spectral_clusters_by_affinity",
    "spectral_embedding_clusters",
}


@pytest.fixture(scope="module")
def duck():
    return connect(TINY)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_twin(spark, duck, name):
    df = entry_point.queries()[name](spark, TINY)
    problems = [p for p in differences(df, duck, entry_point.oracle_sql()[name]) if not p.startswith("note")]
    assert not problems


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql()) - SLOW))
def test_query_without_twin_gives_rows(spark, name):
    assert entry_point.queries()[name](spark, TINY).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["doc_id", "concept", "label", "split", "cosine"]
    assert df.count() > 0
