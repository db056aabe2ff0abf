"""From raw documents to packed token sequences; every stage is one operator of ``conceptlink.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptlink.llm import decontaminate, line_dedup, ngram_join, packing, quality
from conceptlink.llm.common import table
from conceptlink.llm.queries import tokenizer_path
from conceptlink.operators.staging import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network predicts to be poor go; rows without doc_id are judged like all others."""
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.filter_documents(docs, net).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that three or more documents share, except in one; no document goes. n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3, counts=False)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id; rows without doc_id stay."""
    groups = ngram_join.similar_groups(docs, shingle=5, percent=80)
    dropped = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; rows without doc_id stay.

    Items of 1 to 4 words name no document: such short runs stand in clean texts too.
    """
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), least=decontaminate.SUBSTITUTED)
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1,024 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), size=1024)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", drop_poor_documents),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-fit packing", pack),
]

# a trained classifier and a tokenizer have no SQL form; tests/llm compares single operators with brute force, no test the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
