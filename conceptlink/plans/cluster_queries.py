"""Queries over clustering, neighbours and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from conceptlink import fixtures as fx
from conceptlink.functions.vec import tidy as tidy_col
from conceptlink.operators import clustering, density, descent, hierarchy, linkage, many_kmeans, neighbors, spectra, summaries
from conceptlink.plans import cluster_analysis
from conceptlink.plans.registry import query
from conceptlink.plans.source_queries import fresh_path
from conceptlink.plans.twins import hash_key, tidy, with_views
from conceptlink.plans.vector_queries import by_dimension, doc_vecs


def points(spark, sf_dir):
    return fx.points(spark, sf_dir)


# --- neighbours ------------------------------------------------------------------------

# every unordered pair of rows; the twin compares all of them
COS = {
    "n": "SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS len FROM pts",
    "cs": "SELECT a.id AS src, b.id AS dst, list_dot_product(a.vec, b.vec) / (a.len * b.len) AS cosine FROM n a JOIN n b ON a.id < b.id",
}
NEAR_COSINE = 0.3


@query("D14", with_views("pts", extra=COS, body=f"SELECT src, dst, {tidy('cosine')} AS cosine FROM cs WHERE cosine >= {NEAR_COSINE}"))
def similar_vectors(spark, sf_dir):
    edges = neighbors.similarity_edges(points(spark, sf_dir), NEAR_COSINE)
    return edges.select("src", "dst", tidy_col(F.col("cosine")).alias("cosine"))


@query(
    "D15",
    with_views("pts", extra=COS, body=f"""SELECT src, dst, 'x_' || src AS src_name, 'x_' || dst AS dst_name, {tidy('1 - cosine')} AS distance
      FROM cs WHERE cosine >= {NEAR_COSINE}"""),
)
def labelled_distances(spark, sf_dir):
    edges = neighbors.distance_edges(points(spark, sf_dir), 1.0 - NEAR_COSINE)
    return edges.withColumn("distance", tidy_col(F.col("distance")))


@query(
    "D16",
    with_views("pts", extra=COS, body=f"""SELECT src, dst, {tidy('exp(-(1 - cosine) * (1 - cosine) / 0.5)')} AS affinity
      FROM cs WHERE cosine >= {NEAR_COSINE}"""),
)
def affinities(spark, sf_dir):
    edges = neighbors.affinity_edges(points(spark, sf_dir), NEAR_COSINE)
    return edges.select("src", "dst", tidy_col(F.col("affinity")).alias("affinity"))


KNN = {
    "d": "SELECT a.id AS src, b.id AS dst, list_distance(a.vec, b.vec) AS distance FROM pts a JOIN pts b ON a.id <> b.id",
    "knn": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS place FROM d) WHERE place <= 10""",
}


@query("F21", with_views("pts", extra=KNN, body=f"SELECT src, dst, CAST(place AS INTEGER) AS rank, {tidy('distance')} AS distance FROM knn"))
def nearest_neighbors(spark, sf_dir):
    near = neighbors.nearest(points(spark, sf_dir), 10)
    return near.select("src", "dst", F.col("rank").cast("int").alias("rank"), tidy_col(F.col("distance")).alias("distance"))


@query(
    "F22",
    with_views(
        "pts",
        extra={
            **KNN,
            "sig": "SELECT src AS id, distance AS sigma FROM knn WHERE place = 10",
            "und": "SELECT least(src, dst) AS a, greatest(src, dst) AS b, min(distance) AS d FROM knn GROUP BY ALL",
            "aff": """SELECT a, b, exp(-d * d / (x.sigma * y.sigma)) AS v FROM und JOIN sig x ON x.id = a JOIN sig y ON y.id = b""",
        },
        body=f"""SELECT a AS src, b AS dst, {tidy('v')} AS affinity FROM aff UNION ALL SELECT b, a, {tidy('v')} FROM aff""",
    ),
)
def self_tuning_affinities(spark, sf_dir):
    near = neighbors.nearest(points(spark, sf_dir), 10)
    return neighbors.local_affinity(near, 10).select("src", "dst", tidy_col(F.col("affinity")).alias("affinity"))


@query(
    "F7",
    with_views(
        "pts",
        extra={
            "s": f"SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS len FROM pts ORDER BY {hash_key(7, 'id')} LIMIT 500",
            "ds": "SELECT 1 - list_dot_product(a.vec, b.vec) / (a.len * b.len) AS d FROM s a JOIN s b ON a.id <> b.id",
        },
        body=f"SELECT {tidy('(median(d) + min(d)) / 2')} AS eps FROM ds",
    ),
)
def estimated_radius(spark, sf_dir):
    eps = neighbors.estimate_radius(points(spark, sf_dir))
    return spark.createDataFrame([(round(eps, 6),)], "eps double")


@query("F21")
def descended_neighbors(spark, sf_dir):
    """Approximate; tests compare its recall with brute force."""
    return descent.descent_neighbors(points(spark, sf_dir), 10)


# --- clusterings -----------------------------------------------------------------------


def sizes(assigned):
    return assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


@query("F1")
def kmeans_clusters(spark, sf_dir):
    return sizes(clustering.kmeans(points(spark, sf_dir), 7))


@query("F2")
def minibatch_kmeans_clusters(spark, sf_dir):
    return sizes(clustering.minibatch_kmeans(points(spark, sf_dir), 7))


def lloyd_step(i: int) -> dict[str, str]:
    """Views of one Lloyd step: distances to the centres, nearest centre, new centres."""
    return {
        f"a{i}": f"""SELECT id, arg_min(cid, d * 1000 + cid * 1e-9) AS cid FROM (
            SELECT p.id, c.cid, sum((p.v - c.v) * (p.v - c.v)) AS d FROM ptd p JOIN c{i} c USING (dim) GROUP BY p.id, c.cid) GROUP BY id""",
        f"c{i + 1}": f"SELECT cid, dim, avg(v) AS v FROM a{i} JOIN ptd USING (id) GROUP BY cid, dim",
    }


@query(
    "F3",
    with_views(
        "ptd",
        extra={"c0": "SELECT CAST(id AS INTEGER) AS cid, dim, v FROM ptd WHERE id < 5", **lloyd_step(0), **lloyd_step(1), **lloyd_step(2), **lloyd_step(3)},
        body="SELECT id, cid AS cluster_id FROM a3",
    ),
)
def lloyd_steps(spark, sf_dir):
    rows = points(spark, sf_dir).select("id", "vec")
    assigned, _ = clustering.lloyd(rows, clustering.first_centers(rows, 5), iterations=3)
    return assigned.select("id", "cluster_id")


@query("F4")
def spectral_clusters(spark, sf_dir):
    return sizes(clustering.spectral_clusters(points(spark, sf_dir), 5))


@query("F4")
def spectral_clusters_by_affinity(spark, sf_dir):
    return sizes(clustering.spectral_clusters(points(spark, sf_dir), 5, affinity=lambda d: F.exp(-d * d)))


@query("F4")
def spectral_embedding_clusters(spark, sf_dir):
    rows = points(spark, sf_dir)
    edges = neighbors.local_affinity(neighbors.nearest(rows, 10), 10)
    return spectra.embedded_clusters(rows, edges, 5)


@query("F5")
def hierarchical_clusters(spark, sf_dir):
    return sizes(clustering.bisecting(points(spark, sf_dir), 7))


CUT = 1.15


@query(
    "F5",
    with_views(
        "pts",
        extra={
            "d": "SELECT a.id AS src, b.id AS dst, list_distance(a.vec, b.vec) AS distance FROM pts a JOIN pts b ON a.id <> b.id",
            "e": f"""SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS place FROM d)
                     WHERE place <= 30 AND distance <= {CUT}""",
            "u": "SELECT src, dst FROM e UNION SELECT dst, src FROM e",
        },
        body="""SELECT id, min(reach) AS cluster_id FROM (
          WITH RECURSIVE r(id, reach) AS (SELECT id, id FROM pts UNION SELECT u.dst, r.reach FROM r JOIN u ON u.src = r.id)
          SELECT * FROM r) GROUP BY id""",
    ),
)
def single_link_clusters(spark, sf_dir):
    return density.single_link(points(spark, sf_dir), CUT, k=30).select("id", "cluster_id")


LINKED, CUTS = 30, 7
# one merge a step: the whole edge table is the state of the recursion
LINKAGE = {
    "d": "SELECT a.id AS src, b.id AS dst, list_distance(a.vec, b.vec) AS distance FROM pts a JOIN pts b ON a.id <> b.id",
    "e": f"""SELECT src, dst, distance FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS place FROM d)
             WHERE place <= {LINKED}""",
    "one": "SELECT least(src, dst) AS a, greatest(src, dst) AS b, min(distance) AS total FROM e GROUP BY ALL",
    "mer": """SELECT step, a, b, total / n AS height FROM (
        WITH RECURSIVE st(step, a, b, total, n) AS (
          SELECT 0::BIGINT, a, b, total, 1::BIGINT FROM one
          UNION ALL
          SELECT step + 1, least(x, y), greatest(x, y), sum(total), sum(n)::BIGINT FROM (
            SELECT step, total, n, CASE WHEN a = mb THEN ma ELSE a END AS x, CASE WHEN b = mb THEN ma ELSE b END AS y FROM (
              SELECT *, first_value(a) OVER w AS ma, first_value(b) OVER w AS mb FROM st WINDOW w AS (ORDER BY total / n, a, b)))
          WHERE x <> y GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY step ORDER BY total / n, a, b) AS place FROM st) WHERE place = 1""",
}


@query("F5", with_views("pts", extra=LINKAGE, body=f"SELECT a, b, {tidy('height')} AS height FROM mer"))
def average_linkage_merges(spark, sf_dir):
    merges = linkage.average_linkage(neighbors.nearest(points(spark, sf_dir), LINKED))
    return merges.select("a", "b", tidy_col(F.col("height")).alias("height"))


@query(
    "F5",
    with_views(
        "pts",
        extra={
            **LINKAGE,
            "low": f"SELECT a, b FROM mer WHERE step < (SELECT count(*) - {CUTS} FROM pts)",
            "u": "SELECT a AS src, b AS dst FROM low UNION SELECT b, a FROM low",
        },
        body="""SELECT id, min(reach) AS cluster_id FROM (
          WITH RECURSIVE r(id, reach) AS (SELECT id, id FROM pts UNION SELECT u.dst, r.reach FROM r JOIN u ON u.src = r.id)
          SELECT * FROM r) GROUP BY id""",
    ),
)
def average_linkage_clusters(spark, sf_dir):
    return linkage.average_linkage_clusters(points(spark, sf_dir), CUTS, LINKED).select("id", "cluster_id")


EPS, MIN_POINTS = 0.65, 4


@query(
    "F6",
    with_views(
        "pts",
        extra={
            "n": "SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS len FROM pts",
            "e": f"""SELECT a.id AS src, b.id AS dst FROM n a JOIN n b ON 1 - list_dot_product(a.vec, b.vec) / (a.len * b.len) <= {EPS}""",
            "core": f"SELECT src AS id FROM e GROUP BY src HAVING count(*) >= {MIN_POINTS}",
            "ce": "SELECT src, dst FROM e WHERE src IN (SELECT id FROM core) AND dst IN (SELECT id FROM core)",
            "comp": """SELECT id, min(reach) AS c FROM (
                WITH RECURSIVE r(id, reach) AS (SELECT id, id FROM core UNION SELECT ce.dst, r.reach FROM r JOIN ce ON ce.src = r.id)
                SELECT * FROM r) GROUP BY id""",
            "num": "SELECT c, row_number() OVER (ORDER BY c) - 1 AS cluster_id FROM (SELECT DISTINCT c FROM comp)",
            "border": "SELECT e.src AS id, min(c) AS c FROM e JOIN comp ON comp.id = e.dst WHERE e.src NOT IN (SELECT id FROM core) GROUP BY e.src",
            "lab": "SELECT id, c, true AS is_core FROM comp UNION ALL SELECT id, c, false FROM border",
        },
        body="""SELECT pts.id, coalesce(num.cluster_id, -1) AS cluster_id, coalesce(lab.is_core, false) AS is_core
                FROM pts LEFT JOIN lab ON lab.id = pts.id LEFT JOIN num ON num.c = lab.c""",
    ),
)
def density_clusters(spark, sf_dir):
    return density.density_clusters(points(spark, sf_dir), EPS, MIN_POINTS)


@query("F8")
def multi_level_density_clusters(spark, sf_dir):
    levels = density.density_levels(points(spark, sf_dir), min_cluster_size=5)
    return levels.groupBy("level", "cut", "cluster_id").agg(F.count(F.lit(1)).alias("n"))


@query("F8")
def density_hierarchy_clusters(spark, sf_dir):
    found = hierarchy.density_hierarchy(points(spark, sf_dir), min_cluster_size=5, neighbors=15)
    return found.members.select("id", F.concat_ws("-", "cluster.a", "cluster.b").alias("cluster"), tidy_col(F.col("fell")).alias("fell"), "cluster_id")


@query("F9")
def projected_kmeans_clusters(spark, sf_dir):
    rows = doc_vecs(spark, sf_dir).select(F.col("doc_id").alias("id"), "vec")
    return sizes(clustering.projected_kmeans(rows, 10, 10, n_init=2))


# --- describing a clustering -----------------------------------------------------------

MAJORITY = {
    "cnt": "SELECT cluster_id, label, count(*) AS n FROM pts GROUP BY cluster_id, label",
    "maj": "SELECT cluster_id, arg_min(label, -n * 1000 + label) AS majority FROM cnt GROUP BY cluster_id",
    "uniq": "SELECT count(DISTINCT majority) = count(*) AS ok FROM maj",
}


@query(
    "F10",
    with_views("pts", extra=MAJORITY, body="""SELECT CASE WHEN ok THEN majority ELSE cluster_id END AS cluster_id, id, label
      FROM pts JOIN maj USING (cluster_id), uniq"""),
)
def mapped_clusters(spark, sf_dir):
    return summaries.map_clusters(points(spark, sf_dir))


@query("F10", "SELECT label AS cluster_id, vec_id AS id, label FROM embeddings")
def relabelled_clusters(spark, sf_dir):
    # clusters that agree with the labels but for their numbering take the labels' numbers
    renumbered = points(spark, sf_dir).withColumn("cluster_id", 9 - F.col("label"))
    return summaries.map_clusters(renumbered)


@query("F11", with_views("pts", body="SELECT id, cluster_id FROM pts WHERE cluster_id IN (1, 3)"))
def merged_clusters(spark, sf_dir):
    return summaries.merge_clusters(points(spark, sf_dir), [1, 3, 99]).select("id", "cluster_id")


@query(
    "F12",
    with_views("ptd", body=f"""SELECT cluster_id, dim, {tidy('avg(v)')} AS mean, {tidy('median(v)')} AS median FROM ptd GROUP BY cluster_id, dim"""),
)
def cluster_centers(spark, sf_dir):
    rows = points(spark, sf_dir)
    means = by_dimension(summaries.cluster_means(rows), "cluster_id", vec="center").withColumnRenamed("v", "mean")
    medians = by_dimension(summaries.cluster_medians(rows), "cluster_id", vec="center").withColumnRenamed("v", "median")
    return means.join(medians, ["cluster_id", "dim"])


def top_sql(center: str, order: str) -> str:
    return with_views(
        "ptd",
        extra={
            "m": f"SELECT cluster_id, dim, {center}(v) AS m FROM ptd GROUP BY cluster_id, dim",
            "d": """SELECT p.id, p.cluster_id, 1 - sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))) AS d
                    FROM ptd p JOIN m USING (cluster_id, dim) GROUP BY p.id, p.cluster_id""",
        },
        body=f"""SELECT cluster_id, CAST(place AS INTEGER) AS rank, id, {tidy('d')} AS distance FROM (
            SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY d {order}, id) AS place FROM d) WHERE place <= 10""",
    )


def top_rows(top):
    return top.select("cluster_id", F.col("rank").cast("int").alias("rank"), "id", tidy_col(F.col("distance")).alias("distance"))


@query("F13", top_sql("avg", "ASC"))
def members_nearest_to_mean(spark, sf_dir):
    return top_rows(summaries.top_members(points(spark, sf_dir)))


@query("F13", top_sql("avg", "DESC"))
def members_farthest_from_mean(spark, sf_dir):
    return top_rows(summaries.top_members(points(spark, sf_dir), order="farthest"))


@query("F13", top_sql("median", "ASC"))
def members_nearest_to_median(spark, sf_dir):
    rows = points(spark, sf_dir)
    return top_rows(summaries.top_members(rows, centers=summaries.cluster_medians(rows)))


@query(
    "F14",
    with_views("pts", body=f"""SELECT c.cluster_id, l.label, coalesce(n, 0) AS n, {tidy('coalesce(n, 0) / c.size')} AS share
      FROM (SELECT cluster_id, CAST(count(*) AS DOUBLE) AS size FROM pts GROUP BY cluster_id) c, (SELECT DISTINCT label FROM pts) l
      LEFT JOIN (SELECT cluster_id, label, count(*) AS n FROM pts GROUP BY ALL) x ON x.cluster_id = c.cluster_id AND x.label = l.label"""),
)
def label_distribution(spark, sf_dir):
    table = summaries.label_distribution(points(spark, sf_dir))
    return table.select("cluster_id", "label", "n", tidy_col(F.col("share")).alias("share"))


AGREEMENT = {
    "t": "SELECT cluster_id, label, CAST(count(*) AS DOUBLE) AS n FROM pts GROUP BY ALL",
    "ra": "SELECT cluster_id, sum(n) AS a FROM t GROUP BY cluster_id",
    "rb": "SELECT label, sum(n) AS b FROM t GROUP BY label",
    "g": "SELECT CAST(count(*) AS DOUBLE) AS total FROM pts",
    "hh": "SELECT (SELECT -sum(a / total * ln(a / total)) FROM ra, g) AS hc, (SELECT -sum(b / total * ln(b / total)) FROM rb, g) AS hl",
    "mi": "SELECT sum(n / total * ln(total * n / (a * b))) AS mi FROM t JOIN ra USING (cluster_id) JOIN rb USING (label), g",
    "emi": """SELECT sum(m / total * ln(total * m / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(total - a + 1) + lgamma(total - b + 1)
                 - lgamma(total + 1) - lgamma(m + 1) - lgamma(a - m + 1) - lgamma(b - m + 1) - lgamma(total - a - b + m + 1))) AS emi
              FROM (SELECT a, b, total, unnest(range(CAST(greatest(1, a + b - total) AS BIGINT), CAST(least(a, b) AS BIGINT) + 1)) AS m FROM ra, rb, g)""",
    "ps": """SELECT (SELECT sum(n * (n - 1) / 2) FROM t) AS pc, (SELECT sum(a * (a - 1) / 2) FROM ra) AS pa,
                    (SELECT sum(b * (b - 1) / 2) FROM rb) AS pb, (SELECT total * (total - 1) / 2 FROM g) AS pt""",
}


@query(
    "F15",
    with_views("pts", extra=AGREEMENT, body=f"""SELECT metric, {tidy('value')} AS value FROM (
      SELECT 'homogeneity' AS metric, mi / hl AS value FROM mi, hh
      UNION ALL SELECT 'completeness', mi / hc FROM mi, hh
      UNION ALL SELECT 'v_measure', 2 * (mi / hl) * (mi / hc) / (mi / hl + mi / hc) FROM mi, hh
      UNION ALL SELECT 'ARI', (pc - pa * pb / pt) / ((pa + pb) / 2 - pa * pb / pt) FROM ps
      UNION ALL SELECT 'AMI', (mi - emi) / ((hc + hl) / 2 - emi) FROM mi, hh, emi)"""),
)
def agreement_with_labels(spark, sf_dir):
    return summaries.external_metrics(points(spark, sf_dir)).select("metric", tidy_col(F.col("value")).alias("value"))


@query(
    "F16",
    with_views(
        "pts",
        extra={
            "sd": """SELECT a.id, a.cluster_id, b.cluster_id AS other, sum(list_distance(a.vec, b.vec) * list_distance(a.vec, b.vec)) AS s, count(*) AS n
                     FROM pts a JOIN pts b ON true GROUP BY ALL""",
            "ab": """SELECT id, cluster_id, max(CASE WHEN other = cluster_id THEN s / (n - 1) END) AS a, min(CASE WHEN other <> cluster_id THEN s / n END) AS b
                     FROM sd GROUP BY ALL""",
        },
        body=f"SELECT id, cluster_id, {tidy('(b - a) / greatest(a, b)')} AS silhouette FROM ab",
    ),
)
def silhouettes(spark, sf_dir):
    return summaries.silhouettes(points(spark, sf_dir)).withColumn("silhouette", tidy_col(F.col("silhouette")))


@query("F16")
def sampled_silhouette_score(spark, sf_dir):
    return summaries.silhouette_score(points(spark, sf_dir), sample=1000)


@query("F17")
def silhouette_scan(spark, sf_dir):
    scan = many_kmeans.scan_numbers(points(spark, sf_dir), [2, 3, 4, 5, 6, 10, 15, 20])
    return scan.select("k", "silhouette")


@query("F18")
def gap_statistics(spark, sf_dir):
    return many_kmeans.gap_scan(points(spark, sf_dir), range(1, 20))


@query(
    "F19",
    with_views(
        "ptd",
        extra={"m": "SELECT cluster_id, dim, avg(v) AS m FROM ptd GROUP BY ALL", "z": "SELECT cluster_id, count(*) AS n FROM pts GROUP BY cluster_id"},
        body=f"SELECT {tidy('sum((v - m) * (v - m) / (2 * n))')} AS wk FROM ptd JOIN m USING (cluster_id, dim) JOIN z USING (cluster_id)",
    ),
)
def within_dispersion(spark, sf_dir):
    rows = points(spark, sf_dir)
    return summaries.dispersion(rows, summaries.cluster_means(rows)).select(tidy_col(F.col("wk")).alias("wk"))


@query("F19", with_views("ptd", body=f"SELECT CAST(dim AS INTEGER) AS dim, {tidy('min(v)')} AS low, {tidy('max(v)')} AS high FROM ptd GROUP BY dim"))
def bounding_box(spark, sf_dir):
    box = summaries.bounding_box(points(spark, sf_dir))
    return box.select("dim", tidy_col(F.col("low")).alias("low"), tidy_col(F.col("high")).alias("high"))


@query("F20")
def chosen_cluster_count(spark, sf_dir):
    k, gaps, scan = clustering.choose_k(points(spark, sf_dir))
    joined = gaps.select("k", "gap").join(scan, "k", "full")
    return joined.withColumn("chosen", F.col("k") == k)


@query("F23")
def laplacian_eigengaps(spark, sf_dir):
    near = neighbors.nearest(points(spark, sf_dir), 10)
    return clustering.eigengap(neighbors.local_affinity(near, 10))


@query("F23")
def smallest_laplacian_eigenvalues(spark, sf_dir):
    near = neighbors.nearest(points(spark, sf_dir), 10)
    return spectra.laplacian_gaps(neighbors.local_affinity(near, 10), count=30, tolerance=1e-4)


@query("F24")
def cluster_analysis_report(spark, sf_dir):
    path = fresh_path(spark)
    found = cluster_analysis.analyze(points(spark, sf_dir), "kmeans", k=5, labelled=True, path=path)
    return found.metrics


@query("F24")
def document_cluster_sizes(spark, sf_dir):
    ids, _ = cluster_analysis.cluster_documents(doc_vecs(spark, sf_dir), k=5)
    return sizes(ids)
