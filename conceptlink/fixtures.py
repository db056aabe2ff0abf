"""Word vectors and keyword lists derived from the given tables.

The given tables carry neither, so both are derived by rule (FIXTURES.md) and
written once per session, standing in for the two input files a user has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from conceptlink.functions import text as tx
from conceptlink.operators.ranking import global_index
from conceptlink.operators.staging import spread, written

_session_tables: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _session_tables:
        _session_tables[key] = written(build())
    return _session_tables[key]


def raw_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lowercase tokens ``(doc_id, token)``, punctuation and stop words included."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.explode(tx.tokens(F.col("text"), lowercase=True)).alias("token"))


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(token, vec, vec_id)``: tokens ranked by frequency take the vectors in id order."""

    def build() -> DataFrame:
        points = table(spark, sf_dir, "embeddings")
        n = points.count()
        counts = raw_tokens(spark, sf_dir).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        ranked = global_index(counts, [F.desc("n"), "token"], "vec_id").filter(F.col("vec_id") < n)
        return ranked.join(points, "vec_id").select("token", F.col("embedding").alias("vec"), "vec_id")

    return _once(spark, sf_dir, "word_vectors", build)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, keywords)`` with keywords as a list literal."""

    def build() -> DataFrame:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        found = F.filter(tx.tokens(F.col("text"), lowercase=True), lambda w: w.rlike("^[a-z]+$") & (F.length(w) >= 4))
        # a document is one row, so its words are counted and ranked there; rows of a repeated id are counted together
        repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null")
        repeated = written(repeated.select("doc_id"))
        ranked = F.array_sort(F.transform(tx.counted(found), lambda c: F.struct((-c["n"]).alias("n"), c["token"].alias("token"))))
        best = F.transform(F.slice(ranked, 1, 6), lambda c: c["token"])
        own = spread(docs).withColumn("best", F.when(F.col("doc_id").isNotNull(), best))
        if not repeated.isEmpty():
            words = docs.join(repeated, "doc_id", "left_semi").select("doc_id", F.explode(tx.counted(found)).alias("w"))
            counts = words.groupBy("doc_id", "w.token").agg(F.sum("w.n").alias("n"))
            top = Window.partitionBy("doc_id").orderBy(F.desc("n"), "token")
            first = counts.withColumn("rank", F.row_number().over(top)).filter("rank <= 6")
            lists = first.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "token"))).alias("all"))
            own = own.join(lists, "doc_id", "left").withColumn("best", F.coalesce(F.col("all.token"), F.col("best")))
        keywords = F.when(F.size(F.coalesce("best", F.array().cast("array<string>"))) == 0, "[]").otherwise(tx.list_literal(F.col("best")))
        return own.select("doc_id", "text", keywords.alias("keywords"))

    return _once(spark, sf_dir, "documents", build)


def word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, words, concepts)``: cleaned words and parsed keyword lists."""
    return documents(spark, sf_dir).select(
        "doc_id",
        tx.clean_tokens(F.col("text"), lowercase=True).alias("words"),
        tx.parse_list(F.col("keywords")).alias("concepts"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, vec, label, cluster_id)``: labelled vectors with a given clustering by id."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        "label",
        (F.col("vec_id") % 7).cast("int").alias("cluster_id"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, score)``: document quality against text length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")
