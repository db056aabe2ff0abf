"""Queries over text, vocabulary and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions import text as tx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import corpus
from conceptlink.operators.staging import spread, written
from conceptlink.plans.registry import query
from conceptlink.plans.twins import PUNCT, STOP, hash_key, tidy, with_views


def docs(spark, sf_dir):
    return spread(fx.table(spark, sf_dir, "documents").select("doc_id", "text"))


def cap(word: str) -> str:
    # the capital form of a sharp s is two letters, which this engine's upper() leaves out
    return f"CASE left({word}, 1) WHEN 'ß' THEN 'Ss' ELSE upper(left({word}, 1)) END || lower(substr({word}, 2))"


def word_rows(spark, sf_dir):
    return fx.word_lists(spark, sf_dir).select("doc_id", F.posexplode("words").alias("pos", "token"))


def list_summary(df, words):
    """Per text: number of words and a hash of the whole list in order."""
    return df.select("doc_id", F.size(words).cast("long").alias("n"), F.md5(F.concat_ws(" ", words)).alias("list_hash"))


# the case-preserving tokens: what the tokenizer gives without the lowercase option
RAW = """raw AS MATERIALIZED (SELECT doc_id, unnest(m) AS token, unnest(range(len(m))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '\\p{L}+|[0-9]+|[^\\s\\p{L}0-9]') AS m FROM documents))"""


def listed(where: str) -> str:
    return f"""WITH {RAW} SELECT d.doc_id, coalesce(n, 0) AS n, md5(coalesce(line, '')) AS list_hash FROM documents d LEFT JOIN
      (SELECT doc_id, count(*) AS n, string_agg(token, ' ' ORDER BY pos) AS line FROM raw WHERE {where} GROUP BY doc_id) r
      ON r.doc_id = d.doc_id"""


@query("B1", listed("true"))
def tokens(spark, sf_dir):
    return list_summary(docs(spark, sf_dir), tx.tokens(F.col("text")))


@query("B2", listed(f"token NOT IN ({STOP})"))
def tokens_without_stopwords(spark, sf_dir):
    return list_summary(docs(spark, sf_dir), tx.without_stopwords(tx.tokens(F.col("text"))))


@query("B2", listed(f"lower(token) NOT IN ({STOP})"))
def tokens_without_stopwords_any_case(spark, sf_dir):
    return list_summary(docs(spark, sf_dir), tx.without_stopwords(tx.tokens(F.col("text")), case_insensitive=True))


@query("B3", listed(f"instr({PUNCT}, token) = 0"))
def tokens_without_punctuation(spark, sf_dir):
    return list_summary(docs(spark, sf_dir), tx.without_punctuation(tx.tokens(F.col("text"))))


@query("B4")
def stemmed_words(spark, sf_dir):
    words = fx.word_lists(spark, sf_dir).select(F.explode("words").alias("token"))
    return corpus.stem_words(words.distinct()).select("token", "stem")


@query("B5", with_views("kw", body="SELECT doc_id, pos, concept FROM kw"))
def parsed_keywords(spark, sf_dir):
    table = fx.documents(spark, sf_dir).withColumn("concepts", tx.parse_list(F.col("keywords")))
    rows = table.select("doc_id", F.posexplode("concepts").alias("pos", "concept"))
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query(
    "B6",
    """
    WITH m AS (SELECT doc_id, regexp_extract_all(regexp_replace(text, '[,!;-]+', '.', 'g'), '\\p{L}+|[0-9]+|[^\\s\\p{L}0-9]') AS m FROM documents),
    r AS (SELECT doc_id, unnest(m) AS raw, unnest(range(len(m))) AS pos FROM m)
    SELECT d.doc_id, coalesce(n, 0) AS n, md5(coalesce(line, '')) AS list_hash FROM documents d LEFT JOIN (
      SELECT doc_id, count(*) AS n, string_agg(lower(raw), ' ' ORDER BY pos) AS line FROM r
      WHERE regexp_matches(raw, '^\\p{L}+$') OR raw = '.' OR regexp_matches(raw, '[\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}]')
      GROUP BY doc_id) r ON r.doc_id = d.doc_id
    """,
)
def corpus_tokens(spark, sf_dir):
    return list_summary(docs(spark, sf_dir), tx.corpus_tokens(F.col("text")))


@query(
    "B7",
    with_views("tok", body="SELECT token, regexp_replace(lower(strip_accents(token)), '[^a-z]', '', 'g') AS folded FROM (SELECT DISTINCT token FROM tok)"),
)
def words_without_accents(spark, sf_dir):
    return tx.strip_accents(fx.raw_tokens(spark, sf_dir).select("token").distinct(), "token", "folded")


@query("B8", with_views("tok", body=f"SELECT token, {cap('token')} AS capitalized FROM (SELECT DISTINCT token FROM tok)"))
def capitalized_words(spark, sf_dir):
    return fx.raw_tokens(spark, sf_dir).select("token").distinct().withColumn("capitalized", tx.capitalized(F.col("token")))


@query("C1", with_views("words", body="SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT token FROM words)"))
def vocabulary(spark, sf_dir):
    return corpus.vocabulary(word_rows(spark, sf_dir)).select("token", "idx")


@query("C2", with_views("words", body="SELECT token, count(*) AS freq FROM words GROUP BY token ORDER BY freq DESC, token LIMIT 20"))
def most_common_words(spark, sf_dir):
    return corpus.most_common(corpus.frequencies(word_rows(spark, sf_dir)), 20)


CONCEPT_COUNTS = {"c": "SELECT concept, count(*) AS freq FROM kw GROUP BY concept"}


def concept_counts(spark, sf_dir):
    concepts = fx.word_lists(spark, sf_dir).select(F.explode("concepts").alias("concept"))
    return corpus.frequencies(concepts, "concept")


@query(
    "C3",
    with_views(
        "kw",
        extra=CONCEPT_COUNTS,
        body="""(SELECT concept, freq, 'most' AS side FROM c ORDER BY freq DESC, concept LIMIT 10)
                UNION ALL (SELECT concept, freq, 'least' AS side FROM c ORDER BY freq, concept LIMIT 10)""",
    ),
)
def most_and_least_enriched_concepts(spark, sf_dir):
    return corpus.most_and_least_common(concept_counts(spark, sf_dir), 10)


@query("C4", with_views("kw", extra=CONCEPT_COUNTS, body="SELECT concept, freq FROM c ORDER BY freq, concept LIMIT 25"))
def least_common_concepts(spark, sf_dir):
    return corpus.least_common(concept_counts(spark, sf_dir), 25, "concept")


COVERAGE = """
    SELECT metric, {value} AS value FROM (
      SELECT unnest(['mean_hit_ratio', 'max_words', 'min_words', 'median_words', 'empty_texts', 'unique_words', 'unique_known']) AS metric,
             unnest([mean_hit_ratio, max_words, min_words, median_words, empty_texts, unique_words, unique_known]) AS value
      FROM (SELECT avg(CASE WHEN n_words > 0 THEN CAST(n_hit AS DOUBLE) / n_words ELSE 0.0 END) AS mean_hit_ratio,
                   CAST(max(n_words) AS DOUBLE) AS max_words, CAST(min(n_words) AS DOUBLE) AS min_words,
                   CAST(median(n_words) AS DOUBLE) AS median_words,
                   CAST(count(*) FILTER (n_words = 0) AS DOUBLE) AS empty_texts FROM per) a,
           (SELECT CAST(count(*) AS DOUBLE) AS unique_words, CAST(count(wv.token) AS DOUBLE) AS unique_known
            FROM (SELECT DISTINCT token FROM src) u LEFT JOIN wv ON wv.token = u.token) b)
""".format(value=tidy("value"))
PER_TEXT = """SELECT d.doc_id, count(s.token) AS n_words, count(wv.token) AS n_hit
              FROM documents d LEFT JOIN src s ON s.doc_id = d.doc_id LEFT JOIN wv ON wv.token = s.token GROUP BY d.doc_id"""


def rounded(report):
    return report.select("metric", tidy_col(F.col("value")).alias("value"))


@query("C5", with_views("words", "wv", extra={"src": "SELECT doc_id, token FROM words", "per": PER_TEXT}, body=COVERAGE))
def text_coverage(spark, sf_dir):
    return rounded(corpus.coverage(fx.word_lists(spark, sf_dir), fx.word_vectors(spark, sf_dir)))


@query("C5")
def stemmed_text_coverage(spark, sf_dir):
    lists = fx.word_lists(spark, sf_dir)
    return rounded(corpus.stemmed_coverage(lists, fx.word_vectors(spark, sf_dir)))


@query("C5")
def sketched_text_coverage(spark, sf_dir):
    """Coverage of the texts from stored sketches of each source."""
    sources = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    lists = fx.word_lists(spark, sf_dir).join(sources, "doc_id")
    return corpus.sketched_coverage(written(corpus.coverage_sketches(lists, fx.word_vectors(spark, sf_dir), "source")))


@query("C6", with_views("kw", "wv", extra={"src": "SELECT doc_id, concept AS token FROM kw", "per": PER_TEXT}, body=COVERAGE))
def concept_coverage(spark, sf_dir):
    return rounded(corpus.coverage(fx.word_lists(spark, sf_dir), fx.word_vectors(spark, sf_dir), words="concepts"))


@query(
    "C7",
    with_views(
        "words",
        body=f"""SELECT d.doc_id, coalesce(n, 0) AS n_words FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id) w
                 ON w.doc_id = d.doc_id ORDER BY {hash_key(7, 'd.doc_id')} LIMIT 20""",
    ),
)
def inspection_sample(spark, sf_dir):
    sample = corpus.inspection_sample(fx.documents(spark, sf_dir), 20)
    words = tx.clean_tokens(F.col("text"), lowercase=True)
    return sample.select("doc_id", F.size(words).cast("long").alias("n_words"))


@query("C8", "SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY o_orderstatus")
def class_sizes(spark, sf_dir):
    from conceptlink.operators.sampling import class_sizes as sizes

    return sizes(fx.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("label")))


STATUS_TOTALS = """SELECT o_custkey AS customer, o_orderstatus AS status, round(sum(o_totalprice), 2) + 0.0 AS total
                   FROM orders GROUP BY o_custkey, o_orderstatus"""


def status_maps(spark, sf_dir):
    """Nested map per customer: customer to order status to total price."""
    orders = fx.table(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")).agg(
        tidy_col(F.sum("o_totalprice"), 2).alias("total")
    )
    # one entry per status, of which there are three
    inner = totals.groupBy("customer").agg(F.map_from_entries(F.collect_list(F.struct("status", "total"))).alias("inner"))
    return inner.select(F.create_map("customer", "inner").alias("nested"))


@query("C9", f"SELECT status AS key, total AS value FROM ({STATUS_TOTALS}) ORDER BY total, status LIMIT 15")
def smallest_map_entries(spark, sf_dir):
    maps = status_maps(spark, sf_dir).select(F.map_values("nested")[0].alias("entries"))
    return corpus.smallest_entries(maps, "entries", 15)


@query("C10", f"SELECT status AS key, total AS value FROM ({STATUS_TOTALS})")
def flattened_maps(spark, sf_dir):
    return corpus.flattened(status_maps(spark, sf_dir), "nested")


@query("C10", f"SELECT count(*) AS leaves FROM ({STATUS_TOTALS})")
def map_leaf_count(spark, sf_dir):
    return corpus.leaf_count(status_maps(spark, sf_dir), "nested")


WINDOWS = """SELECT doc_id, pos, token AS center,
                    list(token) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS l,
                    list(token) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS r
             FROM words"""
FULL = {"win": f"SELECT doc_id, pos, center, l || r AS context FROM ({WINDOWS}) WHERE len(l) = 2 AND len(r) = 2"}


def windows(spark, sf_dir):
    lists = fx.word_lists(spark, sf_dir)
    return corpus.context_windows(lists, F.col("words"), 2)


@query("C11", with_views("words", extra=FULL, body="SELECT doc_id, pos, center, array_to_string(context, ' ') AS context FROM win"))
def context_windows(spark, sf_dir):
    return windows(spark, sf_dir).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "center", F.concat_ws(" ", "context").alias("context")
    )


@query(
    "C12",
    with_views(
        "words",
        extra={
            **FULL,
            "voc": "SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT token FROM words)",
            "ctx": """SELECT doc_id, pos, center, token, count(*) / 4.0 AS share
                      FROM (SELECT doc_id, pos, center, unnest(context) AS token FROM win) GROUP BY doc_id, pos, center, token""",
        },
        body="""SELECT doc_id, count(*) AS entries, CAST(sum(share) AS DOUBLE) AS mass,
                       CAST(sum(share * v.idx) AS DOUBLE) AS context_sum, CAST(sum(share * c.idx) AS DOUBLE) AS center_sum
                FROM ctx JOIN voc v ON v.token = ctx.token JOIN voc c ON c.token = ctx.center GROUP BY doc_id""",
    ),
)
def training_examples(spark, sf_dir):
    vocab = corpus.vocabulary(word_rows(spark, sf_dir))
    numbered = corpus.numbered_words(fx.word_lists(spark, sf_dir), written(vocab))
    rows = corpus.training_examples(corpus.context_windows(numbered, F.col("words"), 2))
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum("share").alias("mass"),
        F.sum(F.col("share") * F.col("idx")).alias("context_sum"),
        F.sum(F.col("share") * F.col("center_idx")).alias("center_sum"),
    )


@query("C12", with_views("words", body="""SELECT doc_id, pos, idx, 1.0::DOUBLE AS one FROM words JOIN
    (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT token FROM words)) USING (token)"""))
def one_hot_words(spark, sf_dir):
    words = word_rows(spark, sf_dir)
    rows = corpus.one_hot(words, corpus.vocabulary(words))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "idx", "one")


@query(
    "C13",
    with_views("wv", "kw", body="""SELECT token, vec_id FROM wv
      WHERE token IN (SELECT concept FROM kw) OR token IN (SELECT lower(n_name) FROM nation)"""),
)
def restricted_vectors(spark, sf_dir):
    concepts = fx.word_lists(spark, sf_dir).select(F.explode("concepts"))
    names = fx.table(spark, sf_dir, "nation").select(F.lower("n_name"))
    return corpus.restrict_vectors(fx.word_vectors(spark, sf_dir), concepts, names).select("token", "vec_id")


@query("C14", with_views("words", "wv", body=f"""SELECT doc_id, pos, token, {tidy('CAST(vec[1] AS DOUBLE)')} AS first
    FROM words JOIN wv USING (token)"""))
def vectors_in_order(spark, sf_dir):
    known = fx.word_vectors(spark, sf_dir)
    words = word_rows(spark, sf_dir).join(known.select("token"), "token", "left_semi")
    rows = corpus.vectors_in_order(known, words)
    first = tidy_col(F.col("vec")[0].cast("double")).alias("first")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "token", first)


# a dictionary built from the benchmark texts: each word points to the word after it
NEXT = """nxt AS (SELECT token AS source, lead(token) OVER (PARTITION BY item_id ORDER BY pos) AS target,
          item_id * 1000000 + pos AS entry FROM (
            SELECT item_id, lower(raw) AS token, pos FROM (
              SELECT item_id, unnest(m) AS raw, unnest(range(len(m))) AS pos
              FROM (SELECT item_id, regexp_extract_all(text, '\\p{L}+') AS m FROM benchmark))))"""


@query(
    "C15",
    with_views(
        "wv",
        body=f"""SELECT source, target, vec_id FROM (
          WITH {NEXT},
          keyed AS (SELECT {cap('source')} AS source, target, entry FROM nxt WHERE target IS NOT NULL),
          wanted AS (SELECT k.*, row_number() OVER (PARTITION BY source ORDER BY entry) AS place FROM keyed k
                     WHERE source IN (SELECT {cap('token')} FROM wv)),
          first AS (SELECT source, target, target AS vector_of FROM wanted WHERE place = 1),
          ovr AS (SELECT * FROM (VALUES ('The', 'swapped', 'of'), ('Is', NULL, NULL)) t(source, target, vector_of)),
          merged AS (SELECT * FROM first WHERE source NOT IN (SELECT source FROM ovr)
                     UNION ALL SELECT * FROM ovr WHERE target IS NOT NULL)
          SELECT source, target, vec_id FROM merged JOIN wv ON wv.token = merged.vector_of)""",
    ),
)
def translations(spark, sf_dir):
    items = fx.table(spark, sf_dir, "benchmark").select(
        "item_id", F.transform(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)), F.lower).alias("w")
    )
    steps = F.transform(
        F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))),
        lambda token, i: F.struct(token.alias("source"), F.element_at("w", i + 2).alias("target"), i.alias("pos")),
    )
    entries = items.select("item_id", F.explode(steps).alias("s")).select(
        "s.source", "s.target", (F.col("item_id") * 1000000 + F.col("s.pos")).alias("entry")
    )
    known = fx.word_vectors(spark, sf_dir)
    wanted = known.select(tx.capitalized(F.col("token")))
    overrides = spark.createDataFrame(
        [("The", "swapped", "of"), ("Is", None, None)], "source string, target string, vector_of string"
    )
    named = corpus.translations(entries, wanted, known.withColumn("vec", F.col("vec_id")), overrides)
    return named.withColumnRenamed("vec", "vec_id")


@query("C16", with_views("pts", body=f"SELECT {tidy('avg(n)')} AS mean_size FROM (SELECT count(*) AS n FROM pts GROUP BY cluster_id)"))
def mean_cluster_size(spark, sf_dir):
    return corpus.mean_cluster_size(fx.points(spark, sf_dir)).select(tidy_col(F.col("mean_size")).alias("mean_size"))
