"""Queries over sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import corpus, summaries
from conceptlink.operators.staging import staging_root
from conceptlink.plans.registry import query
from conceptlink.plans.twins import tidy, with_views
from conceptlink.sources import results, tables, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fresh_path(spark) -> str:
    return f"{staging_root(spark)}/{uuid.uuid4().hex}"


@query("A1", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_hash FROM documents")
def read_documents(spark, sf_dir):
    docs = tables.read_documents(spark, f"{sf_dir}/documents.parquet", DOCS, "parquet")
    return docs.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_hash"))


def gapped(spark, sf_dir):
    """Documents whose German entries lost their language and crawl entries their source."""
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif("lang", F.lit("de")).alias("lang"), F.nullif("source", F.lit("web")).alias("source")
    )


GAPPED = "SELECT doc_id, nullif(lang, 'de') AS lang, nullif(source, 'web') AS source FROM documents"


@query("A2", f"SELECT * FROM ({GAPPED}) WHERE lang IS NOT NULL AND source IS NOT NULL")
def complete_rows(spark, sf_dir):
    return tables.drop_incomplete(gapped(spark, sf_dir))


@query(
    "A3",
    f"SELECT avg(CASE WHEN lang IS NULL OR source IS NULL THEN 1.0 ELSE 0.0 END) AS missing_share FROM ({GAPPED})",
)
def missing_share(spark, sf_dir):
    return tables.missing_share(gapped(spark, sf_dir))


@query("A3", f"SELECT * FROM ({GAPPED}) WHERE lang IS NULL OR source IS NULL")
def incomplete_rows(spark, sf_dir):
    return tables.incomplete_rows(gapped(spark, sf_dir))


@query("A4", with_views("kw", body="SELECT doc_id, md5(text) AS text_hash, CAST(coalesce(len, 0) AS INTEGER) AS n_keywords FROM documents LEFT JOIN (SELECT doc_id, count(*) AS len FROM kw GROUP BY doc_id) USING (doc_id)"))
def csv_round_trip(spark, sf_dir):
    path = fresh_path(spark)
    tables.write_csv(fx.documents(spark, sf_dir), path)
    back = tables.read_documents(spark, path)
    n = F.size(F.filter(F.split("keywords", "'"), lambda w: w.rlike("^[a-z]+$")))
    return back.select("doc_id", F.md5("text").alias("text_hash"), F.greatest(n, F.lit(0)).alias("n_keywords"))


@query("A5, A6", "SELECT id, label, dim, v FROM (SELECT vec_id AS id, label, unnest(range(len(embedding))) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)")
def matrix_round_trip(spark, sf_dir):
    path = fresh_path(spark)
    points = fx.points(spark, sf_dir).select("id", "vec", "label")
    tables.save_matrix(points, path, "doc")
    tables.save_matrix(points.filter("label = 0"), path, "simple-doc")
    back = tables.load_document_vectors(spark, path)
    rows = back.select("id", "label", F.posexplode("vec").alias("dim", "v"))
    return rows.withColumn("dim", F.col("dim").cast("long"))


@query("A6", """SELECT CASE WHEN vec_id % 3 = 0 THEN 'test' ELSE 'train' END AS part, vec_id AS doc_id, 'c' || CAST(vec_id % 7 AS VARCHAR) AS concept,
  label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x + x)[1] AS first, len(embedding) AS width FROM embeddings""")
def pair_matrix_round_trip(spark, sf_dir):
    """Training and test pairs stored next to a document split of another schema."""
    path = fresh_path(spark)
    points = fx.points(spark, sf_dir)
    concept = F.concat(F.lit("c"), F.col("cluster_id").cast("string")).alias("concept")
    features = F.transform("vec", lambda x: x + x).alias("features")
    rows = points.select(F.col("id").alias("doc_id"), concept, features, "label")
    tables.save_matrix(points.select(F.col("id").alias("doc_id"), "vec"), path, "doc")
    tables.save_matrix(rows.filter("doc_id % 3 <> 0"), path, "train")
    tables.save_matrix(rows.filter("doc_id % 3 = 0"), path, "test")
    train, test = tables.load_pair_vectors(spark, path)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("part", "doc_id", "concept", "label", F.get("features", 0).alias("first"), F.size("features").cast("long").alias("width"))


@query("A7", with_views("wvd", body=f"SELECT token, dim, {tidy('v')} AS v FROM wvd"))
def word_vectors_from_text(spark, sf_dir):
    path = fresh_path(spark)
    known = fx.word_vectors(spark, sf_dir)
    vectors.vector_lines(known).write.text(path)
    back = vectors.read_vectors_text(spark, path)
    rows = back.select("token", F.posexplode("vec").alias("dim", "v"))
    return rows.select("token", F.col("dim").cast("long").alias("dim"), tidy_col(F.col("v").cast("double")).alias("v"))


@query("A8")
def list_files(spark, sf_dir):
    found = tables.list_files(spark, sf_dir, ("*.parquet",))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query("A9", "SELECT s_name AS source, CAST(s_nationkey AS VARCHAR) AS target FROM supplier")
def two_column_dictionary(spark, sf_dir):
    path = fresh_path(spark)
    entries = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("source"), F.col("s_nationkey").cast("string").alias("target")
    )
    tables.write_csv(entries, path, sep=" ")
    return tables.read_dictionary(spark, path).select("source", "target")


CLUSTERS = "SELECT id, cluster_id, label, 'tag ' || CAST(label AS VARCHAR) AS tag FROM pts"


@query("A10", with_views("pts", body=CLUSTERS))
def saved_clusters(spark, sf_dir):
    path = fresh_path(spark)
    points = fx.points(spark, sf_dir)
    tags = points.select("label").distinct().withColumn("tag", F.concat(F.lit("tag "), F.col("label").cast("string")))
    assigned = points.select("id", "cluster_id", "label")
    results.save_clusters(assigned, summaries.top_members(points, k=10), path, "given", tags)
    saved = spark.read.schema("id long, cluster_id int, label int, tag string").csv(f"{path}/cluster_id-given.csv", header=True)
    return saved


@query(
    "A10",
    with_views(
        "ptd",
        extra={
            "mean": "SELECT cluster_id, dim, avg(v) AS m FROM ptd GROUP BY cluster_id, dim",
            "dist": """SELECT p.id, p.cluster_id, 1 - sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))) AS d
                       FROM ptd p JOIN mean USING (cluster_id, dim) GROUP BY p.id, p.cluster_id""",
            "top": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(d, 9), id) AS place FROM dist)
                      WHERE place <= 10""",
        },
        body="SELECT cluster_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS knn FROM top GROUP BY cluster_id",
    ),
)
def saved_neighbor_lists(spark, sf_dir):
    path = fresh_path(spark)
    lists = results.neighbor_lists(summaries.top_members(fx.points(spark, sf_dir), k=10))
    tables.write_csv(lists, path, sep="|")
    return spark.read.schema("cluster_id int, knn string").csv(path, sep="|", header=True)


@query("A10", with_views("pts", body="SELECT id, cluster_id FROM pts"))
def loaded_clusters(spark, sf_dir):
    path = fresh_path(spark)
    points = fx.points(spark, sf_dir)
    tables.write_csv(points.select("id", "cluster_id"), f"{path}/cluster_id-given.csv")
    return results.load_clusters(spark, path, "given", points.drop("cluster_id")).select("id", "cluster_id")


@query("A11", with_views("kw", body="SELECT concept, count(*) AS freq FROM kw GROUP BY concept"))
def concept_frequency_file(spark, sf_dir):
    path = fresh_path(spark)
    concepts = fx.word_lists(spark, sf_dir).select(F.explode("concepts").alias("concept"))
    tables.write_csv(corpus.frequencies(concepts, "concept"), path)
    return spark.read.schema("concept string, freq long").csv(path, header=True)


@query("A12", "SELECT d.doc_id, d.lang, l.quality AS cluster_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def documents_with_clusters(spark, sf_dir):
    assigned = fx.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("cluster_id"))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return results.with_cluster_ids(docs, assigned)
