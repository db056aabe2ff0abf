"""Queries over vectors and vector algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions import vec as vx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import vectors
from conceptlink.plans.registry import query
from conceptlink.plans.twins import tidy, with_views


def by_dimension(df, *keys, vec="vec"):
    rows = df.select(*keys, F.posexplode(vec).alias("dim", "v"))
    return rows.select(*keys, F.col("dim").cast("long").alias("dim"), tidy_col(F.col("v")).alias("v"))


def doc_vecs(spark, sf_dir):
    return vectors.doc_vectors(fx.word_lists(spark, sf_dir), fx.word_vectors(spark, sf_dir))


DOC_DIMS = "SELECT doc_id, dim FROM documents, (SELECT unnest(range(max(len(embedding)))) AS dim FROM embeddings)"


@query("D1", with_views("dv", body=f"SELECT doc_id, dim, {tidy('v')} AS v FROM dv"))
def document_vectors(spark, sf_dir):
    return by_dimension(doc_vecs(spark, sf_dir), "doc_id")


@query(
    "D2",
    with_views(
        "counts",
        "wvd",
        extra={
            "len": "SELECT doc_id, sum(n) AS n FROM counts GROUP BY doc_id",
            "s": "SELECT doc_id, dim, sum(n * v) AS total FROM counts JOIN wvd USING (token) GROUP BY doc_id, dim",
        },
        body=f"""SELECT d.doc_id, d.dim, {tidy('coalesce(s.total / len.n, 0.0)')} AS v FROM ({DOC_DIMS}) d
                 LEFT JOIN s ON s.doc_id = d.doc_id AND s.dim = d.dim LEFT JOIN len ON len.doc_id = d.doc_id""",
    ),
)
def document_vectors_with_unknown_as_zero(spark, sf_dir):
    lists = fx.word_lists(spark, sf_dir)
    return by_dimension(vectors.doc_vectors(lists, fx.word_vectors(spark, sf_dir), exclude_oov=False), "doc_id")


@query(
    "D3",
    with_views(
        "dv",
        "kw",
        extra={
            "cs": """SELECT doc_id, dim, sum(v) / count(*) AS v FROM kw JOIN wvd ON wvd.token = kw.concept GROUP BY doc_id, dim""",
        },
        body=f"""SELECT dv.doc_id, dv.dim, {tidy('dv.v')} AS v, {tidy('coalesce(cs.v, 0.0)')} AS concept_v
                 FROM dv LEFT JOIN cs ON cs.doc_id = dv.doc_id AND cs.dim = dv.dim""",
    ),
)
def document_and_concept_list_vectors(spark, sf_dir):
    both = vectors.document_matrix(fx.word_lists(spark, sf_dir), fx.word_vectors(spark, sf_dir), concepts="concepts")
    rows = both.select("doc_id", F.posexplode(F.arrays_zip("vec", "concept_vec")).alias("dim", "s"))
    return rows.select(
        "doc_id", F.col("dim").cast("long").alias("dim"), tidy_col(F.col("s.vec")).alias("v"), tidy_col(F.col("s.concept_vec")).alias("concept_v")
    )


@query("D3", with_views("words", body="""SELECT count(*) AS n_texts, count(*) FILTER (n IS NULL) AS n_skipped,
    round(avg(CASE WHEN n IS NULL THEN 1.0 ELSE 0.0 END), 6) AS skip_ratio
    FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id) USING (doc_id)"""))
def skipped_texts(spark, sf_dir):
    report = vectors.skipped_texts(fx.word_lists(spark, sf_dir))
    return report.withColumn("skip_ratio", tidy_col(F.col("skip_ratio")))


def concept_pairs(spark, sf_dir):
    return fx.word_lists(spark, sf_dir).select("doc_id", F.explode("concepts").alias("concept"))


PAIR_NORMS = {
    "dn": "SELECT doc_id, sum(v) AS s, sum(v * v) AS q, max(abs(v)) AS top FROM dv GROUP BY doc_id",
    "cn": "SELECT token, sum(v) AS s, sum(v * v) AS q, max(abs(v)) AS top FROM wvd GROUP BY token",
}


def pair_summary(df):
    """Width, sum and sum of squares of each pair vector."""
    f = F.col("features")
    return df.select(
        "doc_id", "concept", F.size(f).cast("long").alias("width"), tidy_col(vx.total(f)).alias("total"), tidy_col(vx.dot(f, f)).alias("squares")
    )


WIDTH = "(SELECT CAST(2 * max(len(embedding)) AS BIGINT) FROM embeddings)"


@query(
    "D4",
    with_views(
        "dv", "kw", extra=PAIR_NORMS,
        body=f"""SELECT kw.doc_id, kw.concept, {WIDTH} AS width, {tidy('dn.s + coalesce(cn.s, 0)')} AS total, {tidy('dn.q + coalesce(cn.q, 0)')} AS squares
                 FROM kw JOIN dn USING (doc_id) LEFT JOIN cn ON cn.token = kw.concept""",
    ),
)
def concatenated_pairs(spark, sf_dir):
    known = fx.word_vectors(spark, sf_dir)
    dim = vectors.dimension(known)
    docs = doc_vecs(spark, sf_dir).select("doc_id", F.col("vec").alias("d"))
    concepts = known.select(F.col("token").alias("concept"), F.col("vec").alias("c"))
    joined = concept_pairs(spark, sf_dir).join(concepts, "concept", "left").join(docs, "doc_id")
    concept = F.coalesce(vx.as_doubles(F.col("c")), vx.zeros(dim))
    return pair_summary(joined.withColumn("features", vectors.concatenated(F.col("d"), concept)))


@query(
    "D5",
    with_views(
        "dv", "kw", extra=PAIR_NORMS,
        body=f"""SELECT kw.doc_id, kw.concept, {WIDTH} AS width,
                   CASE WHEN dn.top > 0 AND cn.top > 0 THEN {tidy('dn.s + cn.s')} ELSE 0.0 END AS total,
                   CASE WHEN dn.top > 0 AND cn.top > 0 THEN {tidy('dn.q + cn.q')} ELSE 0.0 END AS squares
                 FROM kw JOIN dn USING (doc_id) LEFT JOIN cn ON cn.token = kw.concept""",
    ),
)
def pair_vectors_with_zero_rule(spark, sf_dir):
    pairs = concept_pairs(spark, sf_dir)
    return pair_summary(
        vectors.with_pair_vectors(pairs, doc_vecs(spark, sf_dir), fx.word_vectors(spark, sf_dir), exclude_zero=False)
    )


@query(
    "D6",
    with_views(
        "dv", "kw", extra=PAIR_NORMS,
        body=f"""SELECT kw.doc_id, kw.concept, {WIDTH} AS width, {tidy('dn.s + cn.s')} AS total, {tidy('dn.q + cn.q')} AS squares
                 FROM kw JOIN dn USING (doc_id) JOIN cn ON cn.token = kw.concept WHERE dn.top > 0 AND cn.top > 0""",
    ),
)
def nonzero_pair_vectors(spark, sf_dir):
    pairs = concept_pairs(spark, sf_dir)
    return pair_summary(vectors.with_pair_vectors(pairs, doc_vecs(spark, sf_dir), fx.word_vectors(spark, sf_dir)))


@query("D7")
def trained_word_vectors(spark, sf_dir):
    lists = fx.word_lists(spark, sf_dir)
    learned = vectors.train_word_vectors(lists, numPartitions=8)
    return learned.select("token", F.size("vec").alias("dim"))


# each document's vector next to those of its concepts
RELATED = {
    **PAIR_NORMS,
    "dp": """SELECT kw.doc_id, kw.concept, sum(dv.v * w.v) AS dot, sum((dv.v - w.v) * (dv.v - w.v)) AS gap
             FROM kw JOIN dv USING (doc_id) JOIN wvd w ON w.token = kw.concept AND w.dim = dv.dim GROUP BY kw.doc_id, kw.concept""",
}


def doc_and_concept(spark, sf_dir):
    docs = doc_vecs(spark, sf_dir).select("doc_id", F.col("vec").alias("d"))
    concepts = fx.word_vectors(spark, sf_dir).select(F.col("token").alias("concept"), F.col("vec").alias("_c"))
    both = concept_pairs(spark, sf_dir).join(concepts, "concept").join(docs, "doc_id")
    return both.select("doc_id", "concept", "d", vx.as_doubles(F.col("_c")).alias("c"))


@query(
    "D8",
    with_views("dv", "kw", extra=RELATED, body=f"""SELECT doc_id, concept,
      CASE WHEN dn.q > 0 AND cn.q > 0 THEN {tidy('dot / (sqrt(dn.q) * sqrt(cn.q))')} END AS cosine
      FROM dp JOIN dn USING (doc_id) JOIN cn ON cn.token = dp.concept"""),
)
def cosine_similarities(spark, sf_dir):
    both = doc_and_concept(spark, sf_dir)
    return both.select("doc_id", "concept", tidy_col(vx.cosine(F.col("d"), F.col("c"))).alias("cosine"))


@query("D9", with_views("dv", "kw", extra=RELATED, body=f"SELECT doc_id, concept, {tidy('sqrt(gap)')} AS distance FROM dp"))
def euclidean_distances(spark, sf_dir):
    both = doc_and_concept(spark, sf_dir)
    return both.select("doc_id", "concept", tidy_col(vx.euclidean(F.col("d"), F.col("c"))).alias("distance"))


@query(
    "D10",
    with_views(
        "wvd",
        extra={
            "q": """SELECT dim, sum(CASE vec_id WHEN 0 THEN -v ELSE v END) AS v FROM wvd JOIN wv USING (token)
                    WHERE vec_id IN (0, 1, 2) GROUP BY dim""",
            "s": """SELECT w.token, sum(w.v * q.v) / (sqrt(sum(w.v * w.v)) * sqrt(sum(q.v * q.v))) AS cosine
                    FROM wvd w JOIN q USING (dim) WHERE w.token NOT IN (SELECT token FROM wv WHERE vec_id IN (0, 1, 2)) GROUP BY w.token""",
        },
        body=f"SELECT token, {tidy('cosine')} AS cosine FROM s ORDER BY s.cosine DESC, token LIMIT 5",
    ),
)
def analogies(spark, sf_dir):
    known = fx.word_vectors(spark, sf_dir)
    a, b, c = [r["token"] for r in known.filter("vec_id < 3").orderBy("vec_id").collect()]
    found = vectors.analogy(known, a, b, c, k=5)
    return found.select("token", tidy_col(F.col("cosine")).alias("cosine"))


@query(
    "D10",
    with_views(
        "wvd",
        extra={
            "qs": """SELECT x.vec_id AS question, x.token AS a, y.token AS b, z.token AS c FROM wv x
                     JOIN wv y ON y.vec_id = x.vec_id + 1 JOIN wv z ON z.vec_id = x.vec_id + 2""",
            "q": """SELECT question, a, b, c, wa.dim, wb.v - wa.v + wc.v AS v FROM qs JOIN wvd wa ON wa.token = a
                    JOIN wvd wb ON wb.token = b AND wb.dim = wa.dim JOIN wvd wc ON wc.token = c AND wc.dim = wa.dim""",
            "qn": "SELECT question, sqrt(sum(v * v)) AS len FROM q GROUP BY question",
            "wn": "SELECT token, sqrt(sum(v * v)) AS len FROM wvd GROUP BY token",
            "d": """SELECT question, w.token, sum(w.v * q.v) AS dot FROM q JOIN wvd w USING (dim)
                    WHERE w.token NOT IN (a, b, c) GROUP BY question, w.token""",
            "s": "SELECT question, token, dot / (qn.len * wn.len) AS cosine FROM d JOIN qn USING (question) JOIN wn USING (token)",
        },
        body=f"""SELECT question, CAST(place AS INTEGER) AS rank, token, {tidy('cosine')} AS cosine FROM (
            SELECT *, row_number() OVER (PARTITION BY question ORDER BY cosine DESC, token) AS place FROM s) WHERE place <= 5""",
    ),
)
def analogy_table(spark, sf_dir):
    """Every three words that stand next to each other by frequency are a question."""
    known = fx.word_vectors(spark, sf_dir)
    words = known.select(F.col("vec_id"), "token")
    questions = words.select(F.col("vec_id").alias("question"), F.col("token").alias("a"))
    for step, name in ((1, "b"), (2, "c")):
        questions = questions.join(words.select((F.col("vec_id") - step).alias("question"), F.col("token").alias(name)), "question")
    found = vectors.analogies(known, questions, k=5)
    return found.select("question", F.col("rank").cast("int").alias("rank"), "token", tidy_col(F.col("cosine")).alias("cosine"))


@query("D11", with_views("ptd", body=f"SELECT id, dim, {tidy('greatest(v, 0.0)')} AS v FROM ptd"))
def relu_values(spark, sf_dir):
    points = fx.points(spark, sf_dir)
    return by_dimension(points.withColumn("vec", vx.relu(F.col("vec"))), "id")


@query("D11", with_views("ptd", body=f"SELECT id, dim, {tidy('exp(v) / sum(exp(v)) OVER (PARTITION BY id)')} AS v FROM ptd"))
def softmax_values(spark, sf_dir):
    points = fx.points(spark, sf_dir)
    return by_dimension(points.withColumn("vec", vx.softmax(F.col("vec"))), "id")


@query("D12", f"SELECT {tidy('-sum(l_discount * ln((l_tax + 0.01) / 1.01)) / count(*)')} AS cost FROM lineitem")
def cross_entropy_cost(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("y"), ((F.col("l_tax") + 0.01) / 1.01).alias("p")
    )
    return vectors.cross_entropy(lines).select(tidy_col(F.col("cost")).alias("cost"))


@query("D13")
def principal_components(spark, sf_dir):
    projected = vectors.pca(fx.points(spark, sf_dir), 10)
    return projected.select("id", F.posexplode("projected").alias("axis", "v")).groupBy("axis").agg(
        F.round(F.variance("v"), 6).alias("variance"), F.round(F.avg("v"), 6).alias("mean")
    )
