"""Exact neighbour joins without forming all pairs.

Rows are assigned to the nearest of a bounded set of pivots. A row meets the
rows of another cell only when a distance bound allows a result there: for
pivots p (own) and q (other), nothing beyond the border between them is nearer
than ``(|xq|^2 - |xp|^2) / (2 |pq|)``, and nothing in a cell of radius R is
nearer than ``|xq| - R``. Neighbouring cells make a region, and rows travel to
regions, whose number hangs on the cores and not on the rows; within a meeting of two
regions only the cells that a bound leaves open are compared, block by block. A crowded
cell becomes many tasks. Equal vectors are folded into one weighted
row first, so copies cost nothing extra however many there are.

Cosine distance runs on unit vectors, where it is half the squared Euclidean one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from conceptlink.functions import vec as vx
from conceptlink.operators.sampling import subsample
from conceptlink.operators.staging import written

BLOCK = 2048  # rows of either side that are compared at once
MEETINGS = 4  # meetings of two regions for each core
SPAN = 1 << 22  # numbers of the vectors of either side that meet in one task
MAX_PIVOTS = 1024  # pivots travel to every task: at most this many vectors
SLACK = 1e-9  # keeps rounding from cutting off a border case
NEAR = 1 << 17  # distances that stay in the cache
MANY = 8  # times k pairs of a row are too many to measure each


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def to_euclidean(distance: float, metric: str) -> float:
    return float(np.sqrt(2.0 * distance)) if metric == "cosine" else float(distance)


def from_euclidean(column: Column, metric: str) -> Column:
    return column * column / 2.0 if metric == "cosine" else column


@dataclass(frozen=True)
class Cells:
    """Distinct rows ``(id, x, w, home, reach)`` and what is known of their cells."""

    rows: DataFrame
    members: DataFrame | None  # (rep, id) of all rows, or None when no vector repeats
    pivots: np.ndarray
    metric: str

    def extents(self) -> tuple[np.ndarray, np.ndarray]:
        """Radius and number of rows of each cell."""
        found = self.rows.groupBy("home").agg(F.max("reach").alias("far"), F.count(F.lit(1)).alias("n")).collect()
        radii, sizes = np.full(len(self.pivots), -np.inf), np.zeros(len(self.pivots), dtype=np.int64)
        for r in found:
            radii[r["home"]], sizes[r["home"]] = r["far"], r["n"]
        return radii, sizes


def _unit(vec: Column, metric: str) -> Column:
    if metric == "euclidean":
        return vec
    if metric == "cosine":
        return vx.let(vx.norm(vec), lambda n: F.transform(vec, lambda x: x / n))
    raise ValueError(f"unknown metric: {metric}")


def build_cells(points: DataFrame, metric: str = "euclidean", block: int = BLOCK, seed: int = 7) -> Cells:
    """Fold equal vectors and assign the distinct ones to pivots. All-zero vectors have no cosine and are left out."""
    base = points.select("id", vx.as_doubles(F.col("vec")).alias("vec"))
    if metric == "cosine":
        base = base.filter(~vx.is_zero(F.col("vec")))
    folded = base.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w"))
    folded = written(folded.select("id", "w", "vec", _unit(F.col("vec"), metric).alias("x")))
    sizes = folded.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("total")).first()
    members = None
    if sizes["total"] > sizes["n"]:
        reps = folded.select(F.col("id").alias("rep"), "vec")
        members = written(base.join(reps, "vec").select("rep", "id"))
    count = int(min(MAX_PIVOTS, max(1, sizes["n"] // block)))
    chosen = subsample(folded.select("id", "x"), count, ["id"], seed).orderBy("id").collect()
    if not chosen:
        raise ValueError("no rows to compare")
    pivots = np.array([r["x"] for r in chosen])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            d = _distances(_rows(pdf["x"]), pivots)
            home = d.argmin(axis=1)
            yield pdf.assign(home=home.astype("int32"), reach=d[np.arange(len(d)), home])

    kind = dict(points.dtypes)["id"]
    schema = f"id {kind}, w long, x array<double>, home int, reach double"
    rows = written(folded.select("id", "w", "x").mapInPandas(assign, schema))
    return Cells(rows, members, pivots, metric)


def _regions(pivots: np.ndarray, sizes: np.ndarray, span: int) -> np.ndarray:
    """Region of each cell: a cell and those next to it, with at most ``span`` rows together unless one cell has more."""
    region = np.full(len(pivots), -1, dtype=np.int32)
    for r in range(len(pivots)):
        free = np.flatnonzero(region < 0)
        if not len(free):
            break
        near = free[np.argsort(_distances(pivots[free[:1]], pivots[free])[0], kind="stable")]
        region[near[: max(1, np.searchsorted(np.cumsum(sizes[near]), span, side="right"))]] = r
    return region


def _visits(rows: DataFrame, cells: Cells, radii: np.ndarray, region: np.ndarray) -> DataFrame:
    """Cells each row (with radius ``r``) has to visit, its own included, as a bit for each, and the regions they are in."""
    pivots = cells.pivots
    between = _distances(pivots, pivots)
    of_region = region[:, None] == np.arange(region.max() + 1)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            d = _distances(_rows(pdf["x"]), pivots)
            home = pdf["home"].to_numpy()
            own = d[np.arange(len(d)), home][:, None]
            gap = between[home]
            with np.errstate(divide="ignore", invalid="ignore"):
                border = np.where(gap > 0, (d * d - own * own) / (2.0 * gap), 0.0)
            limit = pdf["r"].to_numpy()[:, None] + SLACK
            open_ = (border <= limit) & (d - radii <= limit) & np.isfinite(radii)
            open_[np.arange(len(d)), home] = True
            regions = open_.astype(np.float32) @ of_region.astype(np.float32) > 0
            bits = [row.tobytes() for row in np.packbits(open_, axis=1)]
            yield pdf.assign(cells=bits, regions=[np.flatnonzero(row).astype("int32") for row in regions])

    fields = [f"{name} {kind}" for name, kind in rows.dtypes]
    return rows.mapInPandas(visit, ", ".join([*fields, "cells binary, regions array<int>"]))


def _block_counts(rows: DataFrame, cell: str, block: int) -> DataFrame:
    """Blocks per cell or region; as many rows as there are of these."""
    sizes = rows.groupBy(F.col(cell).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))


def meet(
    visitors: DataFrame,
    residents: DataFrame,
    cells: Cells,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block: int = BLOCK,
    combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """Run ``kernel`` on every pair of visitor and resident blocks that may hold results.

    ``visitors`` carry their radius ``r``; both sides carry ``id, x`` and more. ``combine`` shortens results of several
    kernels to what is as good for all of them; with it whole regions meet in a task, so a row travels about twice as often as there are
    regions, however many rows there are (until a region holds ``SPAN`` numbers). Without it a task's results may be as many as its pairs, so blocks meet.
    """
    radii, sizes = cells.extents()
    span = block
    if combine is not None:
        regions = int(np.ceil(np.sqrt(MEETINGS * visitors.sparkSession.sparkContext.defaultParallelism)))
        span = max(block, min(-(-int(sizes.sum()) // regions), SPAN // max(1, cells.pivots.shape[1])))
    region = _regions(cells.pivots, sizes, span)
    travelling = written(_visits(visitors, cells, radii, region))
    stops = travelling.withColumn("cell", F.explode("regions")).drop("regions")
    settled = residents.withColumn("cell", F.array(*[F.lit(int(r)) for r in region])[F.col("home")])
    v_blocks = _block_counts(travelling.select(F.explode("regions").alias("cell")), "cell", span).withColumnRenamed("blocks", "vs")
    r_blocks = _block_counts(settled, "cell", span).withColumnRenamed("blocks", "hs")
    plan = written(v_blocks.join(r_blocks, "cell"))

    def place(df: DataFrame, mine: str, theirs: str, own: str, other: str) -> DataFrame:
        placed = df.join(plan, "cell").withColumn(own, F.pmod(F.xxhash64("id"), F.col(mine)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).drop("vs", "hs")

    left = place(stops, "vs", "hs", "v", "h").groupBy("cell", "v", "h")
    right = place(settled, "hs", "vs", "h", "v").groupBy("cell", "v", "h")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        done = []
        if len(a) and len(b):
            open_ = np.unpackbits(np.frombuffer(b"".join(a["cells"]), np.uint8).reshape(len(a), -1), axis=1).astype(bool)
            others = [(home, part.iloc[j : j + block]) for home, part in b.groupby("home") for j in range(0, len(part), block)]
            for i in range(0, len(a), block):
                part, mask = a.iloc[i : i + block], open_[i : i + block]
                found = [kernel(part[mask[:, home]], other) for home, other in others if mask[:, home].any()]
                found = [f for f in found if len(f)]
                if found:
                    whole = pd.concat(found, ignore_index=True)
                    done.append(whole if combine is None else combine(whole))
        if not done:
            return pd.DataFrame({f.split()[0]: [] for f in schema.split(", ")})
        if len(done) == 1:
            return done[0]
        whole = pd.concat(done, ignore_index=True)
        return whole if combine is None else combine(whole)

    return left.cogroup(right).applyInPandas(run, schema)


# --- edges within a radius -------------------------------------------------------------


def close_pairs(points: DataFrame, radius: float, metric: str = "cosine", block: int = BLOCK) -> DataFrame:
    """``(src, dst, distance)``, src < dst, for all pairs of rows within ``radius``."""
    cells = build_cells(points, metric, block)
    limit = to_euclidean(radius, metric)
    rows = cells.rows.withColumn("r", F.lit(limit))
    kind = dict(points.dtypes)["id"]

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = _rows(a["x"]), _rows(b["x"])
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        i, j = np.nonzero((_distances(x, y) <= limit + SLACK) & (ids[:, None] < others))
        d = np.linalg.norm(x[i] - y[j], axis=1)
        return pd.DataFrame({"src": ids[i], "dst": others[j], "d": d})

    found = meet(rows, cells.rows, cells, kernel, f"src {kind}, dst {kind}, d double", block)
    edges = found.select("src", "dst", from_euclidean(F.col("d"), metric).alias("distance")).filter(F.col("distance") <= radius)
    return edges if cells.members is None else _spread_edges(edges, cells.members)


def _spread_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges of distinct vectors to edges of all rows, the copies of a vector at distance zero.

    The pairs of a large group of copies are the requested result here; jobs that
    do not need them (density clusters, neighbours) work on the folded rows.
    """
    left = members.select(F.col("rep").alias("src"), F.col("id").alias("a"))
    right = members.select(F.col("rep").alias("dst"), F.col("id").alias("b"))
    across = edges.join(left, "src").join(right, "dst").select("a", "b", "distance")
    copies = left.join(right.withColumnRenamed("dst", "src"), "src").filter("a < b").select("a", "b", F.lit(0.0).alias("distance"))
    both = across.unionByName(copies)
    return both.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "distance")


def similarity_edges(points: DataFrame, min_cosine: float, block: int = BLOCK) -> DataFrame:
    """``(src, dst, cosine)`` for all pairs of rows with at least that cosine."""
    edges = close_pairs(points, 1.0 - min_cosine, "cosine", block)
    return edges.select("src", "dst", (1.0 - F.col("distance")).alias("cosine"))


def affinity_edges(points: DataFrame, min_cosine: float, sigma: float = 0.5, similarity: DataFrame | None = None) -> DataFrame:
    """Gaussian affinity over similarity edges (the given ones, or those of ``points``)."""
    edges = similarity_edges(points, min_cosine) if similarity is None else similarity
    return edges.select("src", "dst", vx.affinity(F.col("cosine"), sigma).alias("affinity"))


def distance_edges(points: DataFrame, max_distance: float, prefix: str = "x") -> DataFrame:
    """Labelled cosine distances ``(src, dst, src_name, dst_name, distance)``."""
    edges = close_pairs(points, max_distance, "cosine")
    name = [F.concat(F.lit(f"{prefix}_"), F.col(c).cast("string")).alias(f"{c}_name") for c in ("src", "dst")]
    return edges.select("src", "dst", *name, "distance")


# --- nearest neighbours ----------------------------------------------------------------


def _near_pairs(x: np.ndarray, y: np.ndarray, radius: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a row of ``x`` and one of ``y``, and their distances: all within the row's radius that may be among its ``k + 1`` nearest.

    Products in single precision, with room for their rounding, leave few pairs to measure exactly. Where they leave
    many, those beyond the (k + 1)-th go, and where that does not help either, products in double precision decide.
    """
    middle = y.mean(axis=0)
    p, q = x - middle, y - middle
    own, other = (p * p).sum(axis=1), (q * q).sum(axis=1)
    room = (x.shape[1] + 8) * 2.0**-22 * (np.sqrt(own) + np.sqrt(other.max())) ** 2
    low, turned, other_low = p.astype(np.float32), (-2.0 * q.T).astype(np.float32), other.astype(np.float32)
    limit = np.minimum(radius * radius - own + room, np.finfo(np.float32).max).astype(np.float32)
    step = max(1, NEAR // len(y))
    found = []
    for a in range(0, len(x), step):
        rough = low[a : a + step] @ turned
        rough += other_low
        hit = np.flatnonzero(rough <= limit[a : a + step, None])
        if len(hit) > MANY * k * len(rough) and len(y) > k + 1:
            far = np.partition(rough, k, axis=1)[:, k] + 2 * room[a : a + step]
            hit = np.flatnonzero(rough <= np.minimum(limit[a : a + step], far)[:, None])
            if len(hit) > MANY * k * len(rough):
                d = _distances(x[a : a + step], y)
                far = np.partition(d, k, axis=1)[:, k] + SLACK
                hit = np.flatnonzero(d <= np.minimum(far, radius[a : a + step])[:, None])
        for b in range(0, len(hit), NEAR):
            i, j = np.divmod(hit[b : b + NEAR], len(y))
            i += a
            d = np.linalg.norm(x[i] - y[j], axis=1)
            keep = d <= radius[i]
            found.append((i[keep], j[keep], d[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def nearest(points: DataFrame, k: int, metric: str = "euclidean", block: int = BLOCK) -> DataFrame:
    """``(src, dst, distance, rank)``: the k nearest other rows of every row, ties by id.

    First the k-th distance within a row's own block gives a radius; then the
    row visits the cells that may hold something nearer.
    """
    cells = build_cells(points, metric, block)
    kind = dict(points.dtypes)["id"]
    blocks = written(_block_counts(cells.rows, "home", block))
    blocked = cells.rows.join(blocks, cells.rows["home"] == blocks["cell"]).drop("cell")
    blocked = blocked.withColumn("h", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        d = _distances(_rows(pdf["x"]), _rows(pdf["x"]))
        np.fill_diagonal(d, np.inf)
        r = np.partition(d, k - 1, axis=1)[:, k - 1] if len(d) > k else np.full(len(d), np.inf)
        return pdf[["id", "w", "x", "home"]].assign(r=r)

    schema = f"id {kind}, w long, x array<double>, home int, r double"
    bounded = written(blocked.groupBy("home", "h").applyInPandas(bound, schema))

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = _rows(a["x"]), _rows(b["x"])
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        # the radius comes from other products, so it is not taken to the last digits; ties are settled by id later
        wide = a["r"].to_numpy() * (1 + 1e-6) + 1e-6 * (1 + np.linalg.norm(x, axis=1))
        i, j, exact = _near_pairs(x, y, wide, k)
        apart = ids[i] != others[j]
        i, j, exact = i[apart], j[apart], exact[apart]
        order = np.lexsort((others[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        return pd.DataFrame({"src": ids[i[keep]], "dst": others[j[keep]], "d": exact[keep]})

    def first(found: pd.DataFrame) -> pd.DataFrame:
        found = found.iloc[np.lexsort((found["dst"], found["d"], found["src"]))]
        return found[found.groupby("src", sort=False).cumcount().to_numpy() < k]

    found = meet(bounded, cells.rows, cells, kernel, f"src {kind}, dst {kind}, d double", block, first)
    best = _first_k(found, k)
    if cells.members is not None:
        best = _spread_neighbors(best, cells.members, k)
    return best.select("src", "dst", from_euclidean(F.col("d"), metric).alias("distance"), "rank")


def _first_k(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy("d", "dst")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _spread_neighbors(best: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Neighbours of distinct vectors to neighbours of all rows.

    Of a vector's copies only the k + 1 lowest ids can be among anyone's k nearest.
    """
    lowest = Window.partitionBy("rep").orderBy("id")
    low = members.withColumn("place", F.row_number().over(lowest)).filter(F.col("place") <= k + 1)
    low = written(low.select("rep", "id"))
    others = best.join(low.withColumnRenamed("rep", "dst"), "dst").select("src", "d", "id")
    own = low.select(F.col("rep").alias("src"), F.lit(0.0).alias("d"), "id")
    w = Window.partitionBy("src").orderBy("d", "id")
    short = others.unionByName(own).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k + 1)
    lists = short.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("near"))
    rows = members.select(F.col("rep").alias("src"), F.col("id").alias("row")).join(lists, "src")
    mine = F.slice(F.filter("near", lambda s: s["id"] != F.col("row")), 1, k)
    spread = rows.select("row", F.posexplode(mine).alias("at", "s"))
    return spread.select(F.col("row").alias("src"), F.col("s.id").alias("dst"), F.col("s.d").alias("d"), (F.col("at") + 1).alias("rank"))


def kth_distance(neighbors: DataFrame, k: int) -> DataFrame:
    return neighbors.filter(F.col("rank") == k).select(F.col("src").alias("id"), F.col("distance").alias("sigma"))


def local_affinity(neighbors: DataFrame, k: int) -> DataFrame:
    """Self-tuning affinity ``exp(-d^2 / (s_i s_j))`` over the neighbour graph, both directions.

    ``s`` is a row's k-th neighbour distance. A row has no affinity to itself,
    and two rows at distance zero with zero scale have affinity one.
    """
    neighbors = written(neighbors)
    scale = kth_distance(neighbors, k)
    pairs = neighbors.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "distance")
    pairs = pairs.groupBy("a", "b").agg(F.min("distance").alias("d"))
    pairs = pairs.join(scale.toDF("a", "sa"), "a").join(scale.toDF("b", "sb"), "b")
    scale2 = F.col("sa") * F.col("sb")
    square = F.col("d") * F.col("d")
    value = F.when(scale2 > 0, F.exp(-square / scale2)).when(square == 0, 1.0).otherwise(0.0)
    one_way = written(pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), value.alias("affinity")))
    return one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "affinity"))


def approximate_nearest_pairs(points: DataFrame, radius: float, bucket: float, tables: int = 4, seed: int = 7) -> DataFrame:
    """Close pairs through Spark ML's random-projection hashing: cheaper, but may miss pairs."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    df = points.select("id", array_to_vector(vx.as_doubles(F.col("vec"))).alias("v"))
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(df)
    pairs = lsh.approxSimilarityJoin(df, df, radius, "distance")
    flat = pairs.select(F.col("datasetA.id").alias("src"), F.col("datasetB.id").alias("dst"), "distance")
    return flat.filter("src < dst")


def estimate_radius(points: DataFrame, sample: int = 500, metric: str = "cosine", seed: int = 7) -> float:
    """Mean of the median and the smallest distance between different rows of a sample of at most ``sample``."""
    base = points.filter(~vx.is_zero(F.col("vec"))) if metric == "cosine" else points
    rows = subsample(base.select("id", vx.as_doubles(F.col("vec")).alias("vec")), sample, ["id"], seed).collect()
    x = np.array([r["vec"] for r in rows])
    if metric == "cosine":
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        d = 1.0 - unit @ unit.T
    else:
        d = _distances(x, x)
    off = d[~np.eye(len(d), dtype=bool)]
    return float((np.median(off) + off.min()) / 2.0)
