"""Pointer jumping over tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptlink.operators.staging import written


def reached(starts: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes on the chains that begin at ``starts`` (node); ``links`` (node, next) has at most one row per node.

    Each round takes what is reached one jump further and then doubles the jumps, so the rounds are the logarithm of the
    longest chain; cycles end too. Every round is written, so plans stay short. Links that lead to no node end a chain.
    """
    jumps = written(links.filter("next is not null"))
    seen = written(starts.select("node").distinct())
    n = seen.count()
    while True:
        step = seen.join(jumps, "node").select(F.col("next").alias("node"))
        seen = written(seen.unionByName(step).distinct())
        now = seen.count()
        if now == n:
            return seen
        n = now
        onward = jumps.select(F.col("node").alias("next"), F.col("next").alias("after"))
        jumps = written(jumps.join(onward, "next").select("node", F.col("after").alias("next")))
