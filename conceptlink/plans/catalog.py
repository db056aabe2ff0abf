"""All registered queries."""

from conceptlink.plans import cluster_queries, corpus_queries, evaluation_queries, pair_queries, source_queries, vector_queries  # noqa: F401
from conceptlink.plans.registry import ENTRIES

__all__ = ["ENTRIES"]
