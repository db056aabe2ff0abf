"""Clusterings by centre, by graph and by hierarchy, and choosing their number."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel, PowerIterationClustering
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from conceptlink.functions import vec as vx
from conceptlink.operators import spectra
from conceptlink.operators.components import connected_components
from conceptlink.operators.many_kmeans import gap_scan, scan_numbers
from conceptlink.operators.neighbors import local_affinity, nearest
from conceptlink.operators.ranking import global_index
from conceptlink.operators.sampling import subsample
from conceptlink.operators.staging import written
from conceptlink.operators.summaries import bounding_box, cluster_means, silhouette_score
from conceptlink.operators.vectors import dimension, pca


FITS_AT_ONCE = 5
SLICE = 1 << 20  # differences held at once
NOISE = -1
ZERO = 1e-7  # Laplacian eigenvalues below this are zero


def _vectors(points: DataFrame, vec: str = "vec") -> DataFrame:
    return points.withColumn("features", array_to_vector(vx.as_doubles(F.col(vec))))


def _at_once(fit: Callable, settings: Sequence) -> list:
    """Independent fits over one cached frame, a few at a time, so that their small jobs overlap."""
    with ThreadPoolExecutor(max_workers=min(FITS_AT_ONCE, len(settings))) as pool:
        futures = [pool.submit(inheritable_thread_target(lambda s=s: fit(s))) for s in settings]
        return [f.result() for f in futures]


# --- k-means ---------------------------------------------------------------------------


def fit_kmeans(points: DataFrame, k: int, n_init: int = 10, max_iter: int = 100, seed: int = 7) -> KMeansModel:
    """Best of ``n_init`` k-means fits by within-cluster squared distance."""
    frame = _vectors(points).select("features").persist()
    try:
        fits = _at_once(lambda i: KMeans(k=k, maxIter=max_iter, seed=seed + i).fit(frame), range(n_init))
    finally:
        frame.unpersist()
    return min(fits, key=lambda m: m.summary.trainingCost)


def within_cost(points: DataFrame, k: int, n_init: int = 1, seed: int = 7) -> float:
    """Within-cluster squared distance of the best k-means fit; for one cluster that around the mean."""
    if k > 1:
        return fit_kmeans(points, k, n_init, seed=seed).summary.trainingCost
    spread = [F.var_pop(F.col("vec")[i]) for i in range(dimension(points))]
    return float(points.agg((F.count(F.lit(1)) * sum(spread, F.lit(0.0))).alias("cost")).first()[0])


def assign(model, points: DataFrame) -> DataFrame:
    """``points`` with the ``cluster_id`` a fitted model gives them."""
    scored = model.transform(_vectors(points))
    return scored.withColumn("cluster_id", F.col("prediction")).drop("features", "prediction")


def kmeans(points: DataFrame, k: int, n_init: int = 10, seed: int = 7) -> DataFrame:
    return assign(fit_kmeans(points, k, n_init, seed=seed), points)


class MiniBatchKMeans:
    """K-means updated batch by batch; also usable from ``foreachBatch``.

    A batch's rows go to their nearest centres; a centre moves to the weighted mean of itself and its new rows, with its
    former weight times ``decay`` (1 weighs all batches alike). Only centres and weights stay between batches. With ``path``,
    a folder all executors share, they are stored by batch number: a learner made anew goes on from there, and a
    batch that was finished before changes nothing when it comes again.
    """

    def __init__(self, k: int, decay: float = 1.0, seed: int = 7, path: str | None = None):
        self.k, self.decay, self.seed, self.path = k, decay, seed, path
        self.centers: list[list[float]] = []
        self.weights: list[float] = []

    def _stored(self, spark: SparkSession) -> list[int]:
        """Numbers of the finished batches, in order."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")
        found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _load(self, spark: SparkSession, number: int) -> None:
        rows = spark.read.parquet(f"{self.path}/batch={number}").orderBy("cluster_id").collect()
        self.centers, self.weights = [list(r["center"]) for r in rows], [r["weight"] for r in rows]

    def restore(self, spark: SparkSession) -> None:
        """Centres after the last finished batch."""
        for number in self._stored(spark)[-1:]:
            self._load(spark, number)

    def update(self, batch: DataFrame, number: int | None = None) -> None:
        """Feed the rows ``(id, vec)`` of a batch; its number is needed with a path alone."""
        spark = batch.sparkSession
        if self.path:
            if number is None:
                raise ValueError("stored centres need the number of the batch")
            done = [n for n in self._stored(spark) if n <= number]
            self.centers, self.weights = [], []
            for last in done[-1:]:
                self._load(spark, last)
            if done and done[-1] == number:
                return
        if not self.centers:
            first = subsample(batch.select("id", "vec"), self.k, ["id"], self.seed).orderBy("id").collect()
            if len(first) < self.k:
                raise ValueError(f"the first batch has fewer than {self.k} rows")
            self.centers, self.weights = [list(map(float, r["vec"])) for r in first], [0.0] * self.k
        for r in cluster_means(nearest_center(batch.select("vec"), self.centers)).collect():
            c, old = r["cluster_id"], self.weights[r["cluster_id"]] * self.decay
            share = r["size"] / (old + r["size"])
            self.centers[c] = [x + share * (m - x) for x, m in zip(self.centers[c], r["center"])]
            self.weights[c] = old + r["size"]
        if self.path:
            rows = [(c, center, w) for c, (center, w) in enumerate(zip(self.centers, self.weights))]
            state = spark.createDataFrame(rows, "cluster_id int, center array<double>, weight double")
            state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def assign(self, points: DataFrame) -> DataFrame:
        return nearest_center(points, self.centers)


def minibatch_kmeans(points: DataFrame, k: int, batches: int = 10, seed: int = 7) -> DataFrame:
    """Mini-batch k-means over hashed batches of the rows."""
    learner = MiniBatchKMeans(k, seed=seed)
    slots = written(points.select("id", "vec", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(batches)).alias("batch")))
    for b in range(batches):
        learner.update(slots.filter(F.col("batch") == b))
    return learner.assign(points)


def nearest_center(points: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """``cluster_id`` of the nearest centre, the lowest number on a tie."""
    c = np.array(centers, dtype=float)
    fields = [(n, t) for n, t in points.dtypes if n != "cluster_id"]

    def place(batches):
        for pdf in batches:
            if not pdf.empty:
                x = np.stack(pdf["vec"].to_numpy())
                # one formula on slices, so that ties do not hang on the batch size
                step = max(1, SLICE // c.size)
                near = [((x[a : a + step, None, :] - c) ** 2).sum(axis=2).argmin(axis=1) for a in range(0, len(x), step)]
                yield pdf.assign(cluster_id=np.concatenate(near).astype("int32"))

    schema = ", ".join([*(f"{n} {t}" for n, t in fields), "cluster_id int"])
    return points.select(*[n for n, _ in fields]).mapInPandas(place, schema)


def lloyd(points: DataFrame, centers: Sequence[Sequence[float]], iterations: int | None = None, limit: int = 300) -> tuple[DataFrame, list[list[float]]]:
    """Plain Lloyd steps from the given centres: assignments and final centres.

    Runs ``iterations`` steps, or until the centres stay the same. Only the
    centres pass through the driver; an emptied cluster is dropped.
    """
    mu = [list(map(float, c)) for c in centers]
    for _ in range(iterations if iterations is not None else limit):
        means = cluster_means(nearest_center(points, mu)).orderBy("cluster_id").collect()
        new = [r["center"] for r in means]
        same, mu = new == mu, new
        if iterations is None and same:
            break
    return nearest_center(points, mu), mu


def first_centers(points: DataFrame, k: int) -> list[list[float]]:
    """Vectors of the k lowest ids."""
    return [list(r["vec"]) for r in points.orderBy("id").limit(k).collect()]


def random_centers(points: DataFrame, k: int, seed: int = 7) -> list[list[float]]:
    return [list(r["vec"]) for r in subsample(points.select("id", "vec"), k, ["id"], seed).collect()]


def projected_kmeans(
    points: DataFrame, k: int = 10, components: int = 10, n_init: int = 10, seed: int = 7, stored: bool = False
) -> DataFrame:
    """K-means on the leading principal components; ``vec`` becomes the projection.

    Centring, the axes and the projection each read all points, so these are written first unless they are ``stored`` already.
    """
    points = points if stored else written(points)
    low = written(pca(points, components).drop("vec").withColumnRenamed("projected", "vec"))
    return kmeans(low, k, n_init, seed)


# --- graph and hierarchy ---------------------------------------------------------------


def spectral(edges: DataFrame, k: int, max_iter: int = 20) -> DataFrame:
    """``(id, cluster_id)`` by power iteration over affinity edges ``(src, dst, affinity)``.

    Every id of ``edges`` gets a row; one without a positive affinity is noise, -1.
    """
    one_way = edges.filter("src < dst and affinity > 0").select(
        F.col("src").cast("long"), F.col("dst").cast("long"), F.col("affinity").cast("double")
    )
    pic = PowerIterationClustering(k=k, maxIter=max_iter, initMode="degree", srcCol="src", dstCol="dst", weightCol="affinity")
    placed = pic.assignClusters(one_way).select("id", F.col("cluster").alias("cluster_id"))
    ids = edges.select(F.explode(F.array(F.col("src").cast("long"), F.col("dst").cast("long"))).alias("id")).distinct()
    return with_noise(ids, placed)


def with_noise(points: DataFrame, placed: DataFrame) -> DataFrame:
    """``points`` with the ``cluster_id`` of ``placed`` (id, cluster_id); rows that have none are noise, -1."""
    found = points.join(placed.select("id", "cluster_id"), "id", "left")
    return found.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(NOISE)))


def spectral_clusters(
    points: DataFrame, k: int, affinity: str | Callable[[Column], Column] = "nearest_neighbors", neighbors: int = 10
) -> DataFrame:
    """Spectral clustering on the neighbour graph of the points.

    ``affinity`` is 'nearest_neighbors' (linked or not), 'self_tuning', or a
    function from a distance column to an affinity. Precomputed edges go to
    :func:`spectral` directly. Every point gets a row; one that no affinity links is noise, -1.
    """
    near = written(nearest(points, neighbors))
    if affinity == "self_tuning":
        return with_noise(points.select("id"), spectral(local_affinity(near, neighbors), k))
    pairs = near.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.min("distance").alias("d"))
    weight = F.lit(1.0) if affinity == "nearest_neighbors" else affinity(F.col("d"))
    return with_noise(points.select("id"), spectral(pairs.select("src", "dst", weight.alias("affinity")), k))


def bisecting(points: DataFrame, k: int, min_size: float = 1.0, seed: int = 7) -> DataFrame:
    """Divisive hierarchy cut into ``k`` clusters."""
    model = BisectingKMeans(k=k, minDivisibleClusterSize=min_size, seed=seed).fit(_vectors(points).select("features"))
    return assign(model, points)


def _singular_values(rows: DataFrame, n: int, k: int) -> np.ndarray:
    """The ``k`` largest ones of a matrix of ``n`` columns with the rows (js, vs); the solver reads the rows for every step, so they are kept."""
    matrix = RowMatrix(rows.select("js", "vs").rdd.map(lambda r: Vectors.sparse(n, r["js"], r["vs"])), n, n)
    held = matrix._java_matrix_wrapper._java_model.rows()
    held.persist(rows.sparkSession.sparkContext._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK))
    try:
        return matrix.computeSVD(k).s.toArray()
    finally:
        held.unpersist(False)


def eigengap(edges: DataFrame, top: int = 5, components: int = 20) -> DataFrame:
    """``(position, eigenvalue, gap, n_clusters)``: the smallest Laplacian eigenvalues and the gaps after them.

    ``edges`` hold an affinity in both directions. The leading singular values s
    of (I + D^-1/2 A D^-1/2) / 2 give the eigenvalues 2 (1 - s) of the normalised
    Laplacian. The ``top`` largest gaps carry a suggested number of clusters.
    """
    edges = written(edges.filter("affinity > 0"))
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.sum("affinity").alias("degree"))
    places = written(global_index(degree, ["id"], "at"))
    n = places.count()
    values = _singular_values(spectra.matrix_rows(places, edges), n, min(components, n - 1))
    lam = np.sort(np.maximum(2.0 * (1.0 - values), 0.0))
    # the solver may miss copies of a repeated value; zero repeats once per connected component
    parts = connected_components(places.select("id"), edges.select("src", "dst"))
    zeros = parts.select("component").distinct().count()
    lam = np.concatenate([np.zeros(zeros), lam[lam > ZERO]])[: max(components, zeros + 1)]
    gaps = np.diff(lam)
    best = set(np.argsort(-gaps, kind="stable")[:top].tolist())
    rows = [
        (i, float(v), float(gaps[i]) if i < len(gaps) else None, i + 1 if i in best else None) for i, v in enumerate(lam)
    ]
    return edges.sparkSession.createDataFrame(rows, "position int, eigenvalue double, gap double, n_clusters int")


def suggested_counts(gaps: DataFrame) -> list[int]:
    """Suggested cluster numbers, largest gap first."""
    return [r["n_clusters"] for r in gaps.filter("n_clusters is not null").orderBy(F.desc("gap"), "position").collect()]


# --- how many clusters -----------------------------------------------------------------


def silhouette_scan(points: DataFrame, candidates: Sequence[int], seed: int = 10) -> DataFrame:
    """``(k, silhouette)`` of a k-means fit per candidate; the best k has the highest score."""
    base = points.select("id", "vec").persist()

    def score(k: int) -> tuple[int, float]:
        labelled = assign(fit_kmeans(base, k, n_init=1, seed=seed), base)
        return int(k), float(silhouette_score(labelled).first()[0])

    try:
        rows = _at_once(score, candidates)
    finally:
        base.unpersist()
    return points.sparkSession.createDataFrame(rows, "k int, silhouette double")


def best_by_silhouette(scan: DataFrame) -> int:
    return scan.orderBy(F.desc("silhouette"), "k").first()["k"]


def reference_points(points: DataFrame, box: Sequence[tuple[float, float]], copy: int, seed: int = 7) -> DataFrame:
    """As many uniform points in a box as there are points, drawn from their ids."""
    low = F.array(*[F.lit(float(lo)) for lo, _ in box])
    width = F.array(*[F.lit(float(hi - lo)) for lo, hi in box])
    span = float(1 << 52)

    def coordinate(w: Column, i: Column) -> Column:
        u = F.pmod(F.xxhash64(F.lit(seed), F.lit(copy), F.col("id"), i), F.lit(1 << 52)) / F.lit(span)
        return low[i] + w * u

    return points.select("id", F.transform(width, coordinate).alias("vec"))


def gap_statistic(
    points: DataFrame,
    candidates: Sequence[int],
    references: int = 10,
    form: str = "tibshirani",
    box: str = "data",
    n_init: int = 1,
    seed: int = 7,
) -> DataFrame:
    """``(k, gap, s_k, log_w, log_w_ref)``: the gap statistic per candidate number of clusters.

    Dispersion is the within-cluster squared distance. ``form`` 'tibshirani' and
    'mean_of_logs' average the logs of the reference dispersions, 'inertia' takes
    the log of their mean. References fill the data's bounding box, or the unit
    cube with ``box='unit'``.
    """
    dim = dimension(points)
    sides = [(0.0, 1.0)] * dim if box == "unit" else [(r["low"], r["high"]) for r in bounding_box(points).orderBy("dim").collect()]

    def costs(df: DataFrame) -> list[float]:
        frame = df.select("id", "vec").persist()
        try:
            return _at_once(lambda k: within_cost(frame, k, n_init, seed), candidates)
        finally:
            frame.unpersist()

    tiny = np.finfo(float).tiny
    own = np.log(np.maximum(costs(points), tiny))
    reference = np.maximum([costs(reference_points(points, sides, b, seed)) for b in range(references)], tiny)
    logs = np.log(reference)
    expected = np.log(reference.mean(axis=0)) if form == "inertia" else logs.mean(axis=0)
    spread = logs.std(axis=0) * math.sqrt(1.0 + 1.0 / references)
    rows = [(int(k), float(e - w), float(s), float(w), float(e)) for k, e, w, s in zip(candidates, expected, own, spread)]
    return points.sparkSession.createDataFrame(rows, "k int, gap double, s_k double, log_w double, log_w_ref double")


def best_by_gap(gaps: DataFrame, rule: str = "argmax") -> int:
    """k with the largest gap, or the first k whose gap reaches the next one less its error ('first')."""
    rows = gaps.orderBy("k").collect()
    if rule == "first":
        for here, after in zip(rows, rows[1:]):
            if here["gap"] >= after["gap"] - after["s_k"]:
                return here["k"]
    return max(rows, key=lambda r: r["gap"])["k"]


def choose_k(
    points: DataFrame,
    low: int = 1,
    high: int | None = None,
    step: int = 5,
    references: int = 15,
    around: int = 10,
    extra: Sequence[int] = (2, 5, 10, 20, 50, 100),
    seed: int = 7,
    most: int | None = 200,
    n_init: int = 1,
) -> tuple[int, DataFrame, DataFrame]:
    """Number of clusters by the gap statistic, with a silhouette scan around it for comparison.

    Without ``high`` the candidates end at half the rows, but at ``most`` (None: no bound). The scan also tries the
    ``extra`` numbers. All models of a table share their scans. Returns the gap's choice and both tables.
    """
    n = points.count()
    high = high or (n // 2 if most is None else min(n // 2, most))
    gaps = gap_scan(points, range(low, high, step), references, "inertia", n_init=n_init, seed=seed)
    by_gap = best_by_gap(gaps)
    near = range(max(by_gap - around, 2), min(by_gap + around, n))
    tried = sorted({*near, *(k for k in extra if k < high)})
    return by_gap, gaps, scan_numbers(points, tried, n_init, seed).select("k", "silhouette")
