"""Queries over pairs, sampling and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions import vec as vx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import features, pairs, sampling
from conceptlink.operators.staging import written
from conceptlink.plans.registry import query
from conceptlink.plans.twins import hash_below, hash_draw, hash_key, tidy, with_views
from conceptlink.plans.vector_queries import doc_vecs


def lists(spark, sf_dir):
    return fx.word_lists(spark, sf_dir)


def concept_lists(spark, sf_dir):
    return lists(spark, sf_dir).select("doc_id", "concepts").filter(F.size("concepts") > 0)


def universe(spark, sf_dir):
    return written(pairs.concept_universe(lists(spark, sf_dir)))


def negatives_sql(own: str, count: str, prefix: str = "") -> dict[str, str]:
    """Twin of the negative draw: ``own(doc_id, idx)`` is barred, ``count(doc_id, n, len)`` asked for."""
    key = hash_key(7, "doc_id", "j")
    size = "(SELECT count(*) FROM uni)"
    return {
        f"{prefix}cand": f"""
            SELECT doc_id, n, j, {hash_draw(key)} % {size} AS idx FROM (SELECT doc_id, n, unnest(range(2 * n + 4)) AS j FROM {count})
            UNION ALL
            SELECT doc_id, n, 2 * n + 4 + t AS j, ({hash_draw(hash_key(7, 'doc_id', "'walk'"))} + t) % {size} AS idx
            FROM (SELECT doc_id, n, unnest(range(least(len + 2 * n, {size} - 1) + 1)) AS t FROM {count})""",
        f"{prefix}neg": f"""
            SELECT doc_id, idx FROM (
              SELECT doc_id, n, idx, row_number() OVER (PARTITION BY doc_id ORDER BY min(j)) AS place
              FROM {prefix}cand c WHERE NOT EXISTS (SELECT 1 FROM {own} o WHERE o.doc_id = c.doc_id AND o.idx = c.idx)
              GROUP BY doc_id, n, idx) WHERE place <= n""",
    }


OWN = {
    "own": "SELECT doc_id, idx, pos FROM kw JOIN uni USING (concept)",
    "cnt": "SELECT doc_id, count(*) AS n, count(*) AS len FROM own GROUP BY doc_id",
}
SPLIT = hash_below(hash_key(7, "doc_id"), 0.6)


@query("E1", with_views("uni", body="SELECT concept, idx FROM uni"))
def concept_universe(spark, sf_dir):
    return universe(spark, sf_dir).select("concept", "idx")


@query("E2", f"SELECT doc_id, CASE WHEN {SPLIT} THEN 'train' ELSE 'test' END AS split FROM documents")
def document_split(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    return sampling.bernoulli_split(docs, 0.6, ["doc_id"])


@query("E3", with_views("kw", body="SELECT doc_id, concept, 1 AS label FROM kw"))
def positive_pairs(spark, sf_dir):
    return pairs.positives(concept_lists(spark, sf_dir))


@query(
    "E4, E6",
    with_views("uni", extra={**OWN, **negatives_sql("own", "cnt")}, body="SELECT doc_id, concept, 0 AS label FROM neg JOIN uni USING (idx)"),
)
def negative_pairs(spark, sf_dir):
    return pairs.negatives(concept_lists(spark, sf_dir), universe(spark, sf_dir))


CAPPED = f"""SELECT doc_id, concept, 1 AS label FROM (
  SELECT doc_id, concept, row_number() OVER (PARTITION BY doc_id ORDER BY {hash_key(7, 'doc_id', 'concept')}) AS place FROM kw)
  WHERE place <= 2"""


@query("E5", with_views("kw", body=CAPPED))
def capped_positive_pairs(spark, sf_dir):
    return pairs.positives(concept_lists(spark, sf_dir), n_per_text=2)


KNOWN = {
    "okdoc": "SELECT doc_id FROM dv GROUP BY doc_id HAVING max(abs(v)) > 0",
    "okcon": "SELECT token AS concept FROM wvd GROUP BY token HAVING max(abs(v)) > 0",
    "docsplit": f"SELECT doc_id, CASE WHEN {SPLIT} THEN 'train' ELSE 'test' END AS split FROM documents",
    "tracked": """SELECT DISTINCT concept FROM kw WHERE doc_id IN (SELECT doc_id FROM docsplit WHERE split = 'train')
                  AND doc_id IN (SELECT doc_id FROM okdoc) AND concept IN (SELECT concept FROM okcon)""",
}


def known_positives(spark, sf_dir):
    """Positives whose document and concept both have a vector, with their split."""
    docs = sampling.bernoulli_split(concept_lists(spark, sf_dir), 0.6, ["doc_id"])
    usable = pairs.usable_documents(doc_vecs(spark, sf_dir))
    known = pairs.known_concepts(fx.word_vectors(spark, sf_dir))
    rows = pairs.positives(docs).join(docs.select("doc_id", "split"), "doc_id")
    return rows.join(usable, "doc_id", "left_semi").join(known, "concept", "left_semi")


def tracked(spark, sf_dir):
    return written(pairs.tracked_concepts(known_positives(spark, sf_dir).filter("split = 'train'")))


@query(
    "E7",
    with_views("kw", "dv", extra=KNOWN, body="""SELECT doc_id, concept FROM kw WHERE doc_id IN (SELECT doc_id FROM docsplit WHERE split = 'test')
      AND concept NOT IN (SELECT concept FROM tracked)"""),
)
def unseen_test_positives(spark, sf_dir):
    docs = sampling.bernoulli_split(concept_lists(spark, sf_dir), 0.6, ["doc_id"])
    test = pairs.positives(docs.filter("split = 'test'"))
    return pairs.unseen_positives(test, tracked(spark, sf_dir)).select("doc_id", "concept")


@query(
    "E8",
    with_views("uni", "dv", extra=KNOWN, body="SELECT concept, concept IN (SELECT concept FROM tracked) AS tracked FROM uni"),
)
def tracked_and_untracked_concepts(spark, sf_dir):
    seen = tracked(spark, sf_dir)
    rest = pairs.untracked_concepts(universe(spark, sf_dir), seen)
    return seen.withColumn("tracked", F.lit(True)).unionByName(rest.withColumn("tracked", F.lit(False)))


@query(
    "E9",
    with_views("words", "kw", body=f"""SELECT count(*) AS n_docs, count(*) FILTER (nw IS NULL OR nk IS NULL) AS n_skipped,
      {tidy('avg(CASE WHEN nw IS NULL OR nk IS NULL THEN 1.0 ELSE 0.0 END)')} AS skip_ratio FROM documents
      LEFT JOIN (SELECT doc_id, count(*) AS nw FROM words GROUP BY doc_id) USING (doc_id)
      LEFT JOIN (SELECT doc_id, count(*) AS nk FROM kw GROUP BY doc_id) USING (doc_id)"""),
)
def skipped_documents(spark, sf_dir):
    report = pairs.skip_report(lists(spark, sf_dir))
    return report.withColumn("skip_ratio", tidy_col(F.col("skip_ratio")))


@query(
    "E9",
    with_views("kw", "dv", extra=KNOWN, body="""SELECT count(*) FILTER (hit) AS n_hit, count(*) FILTER (NOT hit) AS n_missed FROM (
      SELECT doc_id IN (SELECT doc_id FROM okdoc) AND concept IN (SELECT concept FROM okcon) AS hit FROM kw)"""),
)
def hits_and_misses(spark, sf_dir):
    usable = pairs.usable_documents(doc_vecs(spark, sf_dir))
    known = pairs.known_concepts(fx.word_vectors(spark, sf_dir))
    return pairs.hit_report(pairs.positives(concept_lists(spark, sf_dir)), usable, known)


LABELLED = "SELECT doc_id, concept, 1 AS label FROM kw UNION ALL SELECT doc_id, concept, 0 AS label FROM neg JOIN uni USING (idx)"


def labelled(spark, sf_dir):
    docs = concept_lists(spark, sf_dir)
    return pairs.positives(docs).unionByName(pairs.negatives(docs, universe(spark, sf_dir)))


@query("E10", with_views("uni", extra={**OWN, **negatives_sql("own", "cnt")}, body=LABELLED))
def labelled_pairs(spark, sf_dir):
    return labelled(spark, sf_dir)


@query(
    "E11",
    f"SELECT vec_id, label, row_number() OVER (ORDER BY {hash_key(7, 'vec_id')}, vec_id) - 1 AS place FROM embeddings",
)
def shuffled_rows(spark, sf_dir):
    from conceptlink.functions.hashing import order_key
    from conceptlink.operators.ranking import global_index

    points = fx.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    # the place makes the order of sampling.shuffled visible to an order-free comparison
    return global_index(sampling.shuffled(points, ["vec_id"]), [order_key(7, "vec_id"), "vec_id"], "place")


@query("E12", with_views("uni", extra={**OWN, **negatives_sql("own", "cnt")}, body=f"""SELECT p.doc_id, p.concept, p.label,
    md5(d.text) AS text_hash FROM ({LABELLED}) p JOIN documents d USING (doc_id)"""))
def pairs_with_source_text(spark, sf_dir):
    docs = fx.documents(spark, sf_dir).select("doc_id", F.md5("text").alias("text_hash"))
    return labelled(spark, sf_dir).join(docs, "doc_id").select("doc_id", "concept", "label", "text_hash")


def built_sql(test_barred: str = "own") -> dict[str, str]:
    usable = "doc_id IN (SELECT doc_id FROM okdoc)"
    train = "doc_id IN (SELECT doc_id FROM docsplit WHERE split = 'train')"
    return {
        **KNOWN,
        "docs": f"SELECT doc_id FROM okdoc WHERE doc_id IN (SELECT doc_id FROM words) AND doc_id IN (SELECT doc_id FROM kw)",
        "own": "SELECT doc_id, concept, idx FROM kw JOIN uni USING (concept) WHERE doc_id IN (SELECT doc_id FROM docs)",
        "trainown": f"SELECT * FROM own WHERE {train}",
        "traincnt": "SELECT doc_id, count(*) AS n, count(*) AS len FROM trainown GROUP BY doc_id",
        **negatives_sql("trainown", "traincnt", "train"),
        "testown": f"SELECT * FROM own WHERE NOT {train}",
        "rest": "SELECT * FROM testown WHERE concept NOT IN (SELECT concept FROM tracked)",
        "testcnt": f"""SELECT doc_id, n, len FROM (SELECT doc_id, count(*) AS n FROM rest GROUP BY doc_id)
                       JOIN (SELECT doc_id, count(*) AS len FROM {test_barred} GROUP BY doc_id) USING (doc_id)""",
        **negatives_sql(test_barred, "testcnt", "test"),
        "built": """SELECT doc_id, concept, label, split FROM (
            SELECT doc_id, concept, 1 AS label, 'train' AS split FROM trainown
            UNION ALL SELECT doc_id, concept, 0, 'train' FROM trainneg JOIN uni USING (idx)
            UNION ALL SELECT doc_id, concept, 1, 'test' FROM rest
            UNION ALL SELECT doc_id, concept, 0, 'test' FROM testneg JOIN uni USING (idx))
          WHERE concept IN (SELECT concept FROM okcon)""",
    }


def built(spark, sf_dir, **settings):
    docs = lists(spark, sf_dir)
    return pairs.build_pairs(docs, written(doc_vecs(spark, sf_dir)), fx.word_vectors(spark, sf_dir), train_size=0.6, **settings)


@query("E13", with_views("uni", "dv", extra=built_sql("testown"), body="SELECT * FROM built"))
def training_and_test_pairs(spark, sf_dir):
    return built(spark, sf_dir)


@query("E13", with_views("uni", "dv", extra=built_sql("rest"), body="SELECT * FROM built"))
def training_and_test_pairs_as_published(spark, sf_dir):
    """Test negatives barred only from the positives left in the test split."""
    return built(spark, sf_dir, exclude_true_positives=False)


@query(
    "E13, D5, D8",
    with_views(
        "uni",
        "dv",
        extra={
            **built_sql("testown"),
            "dn": "SELECT doc_id, sum(v * v) AS q FROM dv GROUP BY doc_id",
            "cn": "SELECT token, sum(v * v) AS q FROM wvd GROUP BY token",
            "dp": """SELECT b.doc_id, b.concept, b.label, b.split, sum(dv.v * w.v) AS dot
                     FROM built b JOIN dv USING (doc_id) JOIN wvd w ON w.token = b.concept AND w.dim = dv.dim GROUP BY ALL""",
        },
        body=f"""SELECT doc_id, concept, label, split, {tidy('dot / (sqrt(dn.q) * sqrt(cn.q))')} AS cosine
                 FROM dp JOIN dn USING (doc_id) JOIN cn ON cn.token = dp.concept""",
    ),
)
def related_pairs(spark, sf_dir):
    """Labelled pairs of both splits with the cosine of document and concept."""
    docs = lists(spark, sf_dir)
    known = fx.word_vectors(spark, sf_dir)
    doc_vectors = written(doc_vecs(spark, sf_dir))
    rows = pairs.build_pairs(docs, doc_vectors, known, train_size=0.6)
    rows = rows.join(known.select(F.col("token").alias("concept"), F.col("vec").alias("c")), "concept")
    rows = rows.join(doc_vectors.select("doc_id", F.col("vec").alias("d")), "doc_id")
    cosine = tidy_col(vx.cosine(F.col("d"), vx.as_doubles(F.col("c")))).alias("cosine")
    return rows.select("doc_id", "concept", "label", "split", cosine)


# --- sampling --------------------------------------------------------------------------


@query("E14", f"SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY {hash_key(7, 'l_orderkey', 'l_linenumber')}, l_orderkey, l_linenumber LIMIT 2000")
def row_sample(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return sampling.subsample(lines, 2000, ["l_orderkey", "l_linenumber"])


PROPORTIONAL = """quota AS (
  SELECT status, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, status) <= 100 - sum(base) OVER () THEN 1 ELSE 0 END AS quota, size
  FROM (SELECT o_orderstatus AS status, count(*) AS size, 100 * count(*) // sum(count(*)) OVER () AS base, 100 * count(*) % sum(count(*)) OVER () AS rest
        FROM orders GROUP BY o_orderstatus))"""
PLACED = f"""placed AS (SELECT o_orderkey, o_orderstatus AS status,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_key(7, 'o_orderkey')}, o_orderkey) AS place FROM orders)"""


def statuses(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("E15", f"WITH {PROPORTIONAL}, {PLACED} SELECT o_orderkey, status FROM placed JOIN quota USING (status) WHERE place <= quota")
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(statuses(spark, sf_dir), 100, ["o_orderkey"], "status").select("o_orderkey", "status")


@query(
    "E15",
    f"""WITH {PLACED}, quota AS (SELECT status, 100 // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY status) <= 100 % count(*) OVER () THEN 1 ELSE 0 END AS quota
        FROM (SELECT DISTINCT o_orderstatus AS status FROM orders))
        SELECT o_orderkey, status FROM placed JOIN quota USING (status) WHERE place <= quota""",
)
def uniform_class_sample(spark, sf_dir):
    sample = sampling.stratified_sample(statuses(spark, sf_dir), 100, ["o_orderkey"], "status", uniform=True)
    return sample.select("o_orderkey", "status")


@query(
    "E15",
    f"""WITH {PROPORTIONAL}, {PLACED}, draws AS (SELECT status, size, CAST(unnest(range(CAST(quota AS BIGINT))) + 1 AS BIGINT) AS draw FROM quota)
        SELECT o_orderkey, p.status FROM draws d JOIN placed p ON p.status = d.status
          AND p.place = {hash_draw(hash_key(7, 'd.status', 'd.draw'))} % d.size + 1""",
)
def stratified_sample_with_replacement(spark, sf_dir):
    sample = sampling.stratified_sample(statuses(spark, sf_dir), 100, ["o_orderkey"], "status", replace=True)
    return sample.select("o_orderkey", "status")


@query("E16", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS part FROM orders")
def near_equal_parts(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    parts = sampling.near_equal_parts(orders, 7, ["o_orderkey"])
    return parts.select("o_orderkey", F.col("part").cast("long").alias("part"))


@query(
    "E17",
    with_views(
        "pts",
        extra={
            "q": """SELECT cluster_id, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, cluster_id) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS quota
                    FROM (SELECT cluster_id, want, want * count(*) // total AS base, want * count(*) % total AS rest
                          FROM pts, (SELECT count(*) AS total, greatest(1, count(*) // 10) AS want FROM pts) GROUP BY cluster_id, want, total)""",
            "r": f"SELECT id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY {hash_key(7, 'id')}, id) AS place FROM pts",
        },
        body="SELECT id, cluster_id FROM r JOIN q USING (cluster_id) WHERE place <= quota",
    ),
)
def cluster_sample(spark, sf_dir):
    return sampling.cluster_sample(fx.points(spark, sf_dir).select("id", "cluster_id"), ["id"]).select("id", "cluster_id")


# --- features --------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(*LINE_KEY, *MEASURES)


def rounded(df, columns):
    return df.select(*LINE_KEY, *[tidy_col(F.col(c)).alias(c) for c in columns])


@query("E18", f"SELECT l_orderkey, l_linenumber, {', '.join(MEASURES)}, l_returnflag FROM lineitem")
def feature_columns(spark, sf_dir):
    table = fx.table(spark, sf_dir, "lineitem")
    dropped = ["l_partkey", "l_suppkey", "l_linestatus", "l_shipdate"]
    xy = features.to_features(table, cols_y=["l_returnflag"], untracked=dropped, key=LINE_KEY)
    return features.from_features(xy, MEASURES).select(*LINE_KEY, *MEASURES, "l_returnflag")


def scaled_sql(expr: str) -> str:
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{tidy(expr.format(c=c))} AS {c}" for c in MEASURES) + " FROM lineitem"


@query("E19", scaled_sql("({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"))
def standardized(spark, sf_dir):
    return rounded(features.scale(lines(spark, sf_dir), MEASURES, "standardize"), MEASURES)


@query("E19", scaled_sql("({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"))
def min_max_scaled(spark, sf_dir):
    return rounded(features.scale(lines(spark, sf_dir), MEASURES, "minmax"), MEASURES)


@query("E19", scaled_sql("{c} / sqrt(" + " + ".join(f"{m} * {m}" for m in MEASURES) + ")"))
def row_normalized(spark, sf_dir):
    return rounded(features.scale(lines(spark, sf_dir), MEASURES, "norm"), MEASURES)


@query("E20", "SELECT p_partkey, CASE WHEN p_brand = (SELECT min(p_brand) FROM part) THEN 1 ELSE 0 END AS target FROM part")
def one_vs_all_labels(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    first = part.agg(F.min("p_brand")).first()[0]
    encoded, _ = features.encode_labels(part, "p_brand", first)
    return encoded.select("p_partkey", "target")


def noise_sql(c: str) -> str:
    u = f"({hash_draw(hash_key(7, 'l_orderkey', 'l_linenumber', chr(39) + c + chr(39)))} / {float(16**13)!r})"
    return f"{tidy(f'{c} + {u} * (m / 100.0 - m / 1000.0) + m / 1000.0')} AS {c}"


@query(
    "E21",
    f"""SELECT l_orderkey, l_linenumber, {', '.join(noise_sql(c) for c in MEASURES)} FROM lineitem,
        (SELECT least({', '.join(f'min({c}) FILTER ({c} > 0)' for c in MEASURES)}) AS m FROM lineitem)""",
)
def perturbed(spark, sf_dir):
    return rounded(features.perturb(lines(spark, sf_dir), MEASURES, LINE_KEY), MEASURES)
