"""New documents as a stream: vectors, scores and running cluster centres.

A document is one row, so no watermark and no state across batches is needed:
each micro-batch runs the batch operators. A batch writes to a folder of its
own number, so a batch that is run again after a failure replaces its output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from conceptlink.functions import text as tx
from conceptlink.operators.clustering import MiniBatchKMeans
from conceptlink.operators.vectors import doc_vectors


def _per_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str) -> DataStreamWriter:
    def run(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(run)


def vectorize(stream: DataFrame, vectors: DataFrame, path: str, lowercase: bool = False) -> DataStreamWriter:
    """Write a vector for every arriving ``(doc_id, text)`` row."""

    def work(batch: DataFrame) -> DataFrame:
        lists = batch.select("doc_id", tx.clean_tokens(F.col("text"), lowercase).alias("words"))
        return doc_vectors(lists, vectors)

    return _per_batch(stream, work, path)


def update_centers(stream: DataFrame, learner: MiniBatchKMeans) -> DataStreamWriter:
    """Feed every arriving batch of ``(id, vec)`` rows to a mini-batch k-means.

    With a learner that stores its centres, a stream that is stopped or fails goes on from the last finished batch.
    """

    def run(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            learner.update(batch, number)

    return stream.writeStream.foreachBatch(run)
