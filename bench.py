"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from conceptlink import fixtures
from conceptlink.plans.catalog import ENTRIES
from conceptlink.session import local_session

HEADLINE = [
    "tokens",
    "text_coverage",
    "vocabulary",
    "context_windows",
    "document_vectors",
    "nonzero_pair_vectors",
    "negative_pairs",
    "training_and_test_pairs",
    "related_pairs",
    "stratified_sample",
    "standardized",
    "nearest_neighbors",
    "density_clusters",
    "cluster_centers",
    "cluster_analysis_report",
    "silhouettes",
    "mean_roc_curve",
    "metric_report",
    "cross_validation_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    start = time.time()
    # the two input files of a user, written once
    fixtures.word_vectors(spark, sf_dir)
    fixtures.documents(spark, sf_dir)
    seconds = {"derive_inputs": round(time.time() - start, 3)}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs):
            start = time.time()
            ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
