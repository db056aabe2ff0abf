"""Leading eigenvectors of a graph by block subspace iteration; vectors are columns of a table, never of the driver.

A graph that fits into a task (``HELD``) goes whole to as many tasks as there are cores, and each multiplies a few vectors of the
block as often as a round asks for; only turning the block goes over its rows. Of a larger graph each product is a join.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.operators.ranking import global_index
from conceptlink.operators.staging import partition_keys, written

_SPARE = 8  # vectors beyond those asked for: they make the others settle sooner
_DEGREE = 8  # products with the matrix between two rotations
_MOST_DEGREE = 300  # of them within a task
_GAIN = 1e6  # by which a round may raise the leading vector over the least one of its block
_AT_ONCE = 1 << 17  # numbers of a product that stay in the cache
HELD = 1 << 24  # entries of a matrix that a task holds whole
NOISE = -1


def _start(columns: int, seed: int) -> Column:
    """Numbers between -1 and 1 drawn from the id."""
    one = lambda j: F.pmod(F.xxhash64(F.lit(seed), F.lit(j), "id"), F.lit(1 << 52)) / F.lit(float(1 << 51)) - 1
    return F.array(*[one(j) for j in range(columns)])


def _product(cells: DataFrame, vectors: DataFrame, column: str, width: int) -> DataFrame:
    """(id, product): the matrix ``cells`` (src, dst, v) times the block ``column`` of ``vectors``; one join and one sum."""
    held = cells.join(vectors.select(F.col("id").alias("dst"), F.col(column).alias("x")), "dst")
    sums = held.groupBy(F.col("src").alias("id")).agg(*[F.sum(F.col("v") * F.col("x")[j]).alias(f"s{j}") for j in range(width)])
    return sums.select("id", F.array(*[F.coalesce(F.col(f"s{j}"), F.lit(0.0)) for j in range(width)]).alias("product"))


def _blocks(vectors: DataFrame, width: int) -> np.ndarray:
    """X'X, X'Y and Y'Y of the columns x and y, summed over all rows; the driver gets these three matrices alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, width, width))
        for pdf in batches:
            if len(pdf):
                x, y = np.stack(pdf["x"].to_numpy()), np.stack(pdf["y"].to_numpy())
                total += [x.T @ x, x.T @ y, y.T @ y]
        yield pd.DataFrame({"at": range(3 * width), "row": list(total.reshape(-1, width))})

    parts = vectors.select("x", "y").mapInPandas(run, "at int, row array<double>").select("at", F.posexplode("row").alias("j", "v"))
    out = np.zeros((3 * width, width))
    for r in parts.groupBy("at", "j").agg(F.sum("v").alias("v")).collect():
        out[r["at"], r["j"]] = r["v"]
    return out.reshape(3, width, width)


def _rotated(vectors: DataFrame, turn: np.ndarray) -> DataFrame:
    """Both blocks times a small matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x, y = (list(np.stack(pdf[c].to_numpy()) @ turn) for c in ("x", "y"))
                yield pdf.assign(x=x, y=y)

    return vectors.mapInPandas(run, vectors.schema)


def _turn(xx: np.ndarray, xy: np.ndarray, yy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matrix that turns a block to the best vectors it holds, their values (largest first) and residuals."""
    root = np.linalg.cholesky(xx + np.eye(len(xx)) * np.trace(xx) * 1e-15)
    inner = np.linalg.solve(root, np.linalg.solve(root, (xy + xy.T) / 2).T)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    turn = np.linalg.solve(root.T, vectors)
    return turn, values, np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, yy, turn) - values**2, 0.0))


class _Matrix:
    """A sparse matrix with an entry in every row."""

    def __init__(self, rows: pa.Table):
        order = np.argsort(rows["at"].to_numpy())
        rows = rows.take(pa.array(order)).combine_chunks()
        js, vs = (rows[c].combine_chunks() for c in ("js", "vs"))
        ends = np.cumsum(js.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        self.to, self.v = js.flatten().to_numpy(zero_copy_only=False), vs.flatten().to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], ends])

    def product(self, x: np.ndarray) -> np.ndarray:
        y, n = np.empty(x.shape), len(x)
        step = max(1, _AT_ONCE // x.shape[1])
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + step, side="right")) - 1)
            lo, hi = self.starts[a], self.starts[b]
            np.add.reduceat(x[self.to[lo:hi]] * self.v[lo:hi, None], self.starts[a:b] - lo, axis=0, out=y[a:b])
            a = b
        return y

    def filtered(self, x: np.ndarray, c: float, degree: int) -> np.ndarray:
        """The Chebyshev polynomial T_degree(2 M / c - 1) times ``x``, its columns of length one."""
        old = x
        for i in range(degree):
            y = self.product(x) * (2 / c) - x
            x, old = (y, x) if i == 0 else (2 * y - old, x)
        return x / np.maximum(np.linalg.norm(x, axis=0), np.finfo(float).tiny)


def _held_vectors(nodes: DataFrame, n: int, k: int, tolerance: float, rounds: int, seed: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``leading_vectors`` of ``nodes`` (id, at, degree, js, vs): a row of the matrix each, numbered densely from 0."""
    spark = nodes.sparkSession
    width, k = min(n, k + _SPARE), min(n, k)
    keys = partition_keys(spark, min(width, spark.sparkContext.defaultParallelism))
    columns = {key: np.arange(i, width, len(keys)) for i, key in enumerate(keys)}
    to_all = F.explode(F.array(*[F.lit(key) for key in keys])).alias("slot")
    matrix = nodes.select("at", "js", "vs", to_all)

    def once(block: DataFrame, turn: np.ndarray, c: float, degree: int) -> DataFrame:
        """The turned block after a round, and its product with the matrix."""

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf["x"].to_numpy()) @ turn
                    for key, mine in columns.items():
                        yield pd.DataFrame({"slot": key, "at": pdf["at"], "x": list(x[:, mine])})

        def run(vectors: pa.Table, rows: pa.Table) -> pa.Table:
            m = _Matrix(rows)
            at = vectors["at"].to_numpy()
            x = np.empty((n, len(vectors["x"][0])))
            x[at] = vectors["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(x.shape)
            x = m.filtered(x, c, degree)
            ends = np.arange(n + 1, dtype=np.int32) * x.shape[1]
            lists = [pa.ListArray.from_arrays(ends, pa.array(b.reshape(-1))) for b in (x, m.product(x))]
            slot = pa.array(np.full(n, vectors["slot"][0].as_py(), dtype=np.int32))
            return pa.table({"slot": slot, "at": pa.array(np.arange(n)), "x": lists[0], "y": lists[1]})

        sliced = block.select("at", "x").mapInPandas(cut, "slot int, at long, x array<double>")
        left, right = (df.repartition(len(keys), "slot").groupBy("slot") for df in (sliced, matrix))
        done = left.cogroup(right).applyInArrow(run, "slot int, at long, x array<double>, y array<double>")
        lists = done.groupBy("at").agg(*[F.array_sort(F.collect_list(F.struct("slot", c))).alias(c) for c in ("x", "y")])
        return written(lists.select("at", *[F.flatten(F.col(c)[c]).alias(c) for c in ("x", "y")]))

    start = nodes.select("at", _start(width, seed).alias("x"))
    block = once(start, np.eye(width), 0.5, 0 if width == n else _DEGREE)
    for _ in range(rounds):
        turn, values, residuals = _turn(*_blocks(block, width))
        if residuals[:k].max() < tolerance or width == n:
            first = _rotated(block.select("at", "x", "y"), turn).select("at", F.slice("x", 1, k).alias("x"))
            return nodes.select("id", "at", "degree").join(first, "at").select("id", "degree", "x"), 2 * (1 - values[:k]), residuals[:k]
        c = min(max(float(values[-1]), 1e-3), 1 - 1e-9)
        # no further than the residuals ask for
        asked = np.log(6 * max(residuals[:k].max() / tolerance, 1.0)) / np.arccosh(max(2 * values[k - 1] / c - 1, 1 + 1e-9))
        degree = int(np.clip(min(np.log(2 * _GAIN) / np.arccosh(2 / c - 1), asked), 1, _MOST_DEGREE))
        block = once(block, turn, c, degree)
    raise RuntimeError(f"residuals up to {residuals[:k].max()} after {rounds} rounds")


def matrix_rows(places: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, at, degree, js, vs): the rows of (I + D^-1/2 A D^-1/2) / 2 for ``places`` (id, at, degree), each with its columns in order."""
    a = places.select(F.col("id").alias("src"), F.col("at"), F.col("degree").alias("da"))
    b = places.select(F.col("id").alias("dst"), F.col("at").alias("j"), F.col("degree").alias("db"))
    cells = edges.join(a, "src").join(b, "dst").select("at", "j", (F.col("affinity") / F.sqrt(F.col("da") * F.col("db")) / 2).alias("v"))
    cells = cells.unionByName(places.select("at", F.col("at").alias("j"), F.lit(0.5).alias("v")))
    summed = cells.groupBy("at", "j").agg(F.sum("v").alias("v"))
    packed = summed.groupBy("at").agg(F.array_sort(F.collect_list(F.struct(F.col("j").cast("int").alias("j"), "v"))).alias("c"))
    packed = packed.select("at", F.col("c.j").alias("js"), F.col("c.v").alias("vs"))
    return written(places.join(packed, "at").select("id", "at", "degree", "js", "vs"))


def leading_vectors(edges: DataFrame, k: int, tolerance: float = 1e-6, rounds: int = 60, seed: int = 7) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Eigenvectors of the ``k`` smallest eigenvalues of the normalised Laplacian of ``edges`` (src, dst, affinity, both directions).

    Returns (id, degree, x) with one number per eigenvector, the eigenvalues, and the residuals: how far the matrix's product with a vector is
    from its multiple. Iterates until all residuals are below ``tolerance``, or raises after ``rounds`` rounds. The table has a row
    for each id with a positive affinity.

    Works on (I + D^-1/2 A D^-1/2) / 2, whose largest eigenvalues belong to the smallest ones of the Laplacian and which has none below
    zero. A round multiplies a block of vectors several times, as a Chebyshev polynomial that dampens what lies below
    the block's smallest value, and then turns the block so that its columns are the best vectors it holds. A multiplication is
    a join of the edge table and an aggregation; repeated and zero eigenvalues need no care, since the block holds several vectors.
    """
    edges = written(edges.filter("affinity > 0").select("src", "dst", "affinity"))
    degree = written(edges.groupBy(F.col("src").alias("id")).agg(F.sum("affinity").alias("degree")))
    n = degree.count()
    if not n:
        raise ValueError("no edges with a positive affinity")
    if edges.count() + n <= HELD:
        places = written(global_index(degree, ["id"], "at"))
        return _held_vectors(matrix_rows(places, edges), n, k, tolerance, rounds, seed)
    width, k = min(n, k + _SPARE), min(n, k)
    a, b = degree.toDF("src", "da"), degree.toDF("dst", "db")
    scaled = edges.join(a, "src").join(b, "dst").select("src", "dst", (F.col("affinity") / F.sqrt(F.col("da") * F.col("db")) / 2).alias("v"))
    cells = written(scaled.unionByName(degree.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.5).alias("v"))))

    def multiplied(block: DataFrame) -> DataFrame:
        return block.drop("y").join(_product(cells, block, "x", width).withColumnRenamed("product", "y"), "id")

    block = written(multiplied(degree.select("id", "degree", _start(width, seed).alias("x"))))
    for _ in range(rounds):
        turn, values, residuals = _turn(*_blocks(block, width))
        block = written(_rotated(block, turn))
        if residuals[:k].max() < tolerance or width == n:
            first = block.select("id", "degree", F.slice("x", 1, k).alias("x"))
            return first, 2 * (1 - values[:k]), residuals[:k]
        # T_d(2 M / c - 1), by its three-term rule
        c = max(float(values[-1]), 1e-3)
        step = F.zip_with("y", "x", lambda y, x: 2 / c * y - x)
        block = block.select("id", "degree", F.col("x").alias("old"), step.alias("x"))
        for _ in range(_DEGREE - 1):
            block = multiplied(block)
            step = F.zip_with(F.zip_with("y", "x", lambda y, x: 2 * (2 / c * y - x)), "old", lambda z, o: z - o)
            block = written(block.select("id", "degree", F.col("x").alias("old"), step.alias("x")))
        block = written(multiplied(block.drop("old")))
    raise RuntimeError(f"residuals up to {residuals[:k].max()} after {rounds} rounds")


def spectral_embedding(edges: DataFrame, k: int, tolerance: float = 1e-6) -> DataFrame:
    """``(id, vec)``: ``k`` spectral coordinates of each id, its entries of the eigenvectors over the root of its degree."""
    found, _, _ = leading_vectors(edges, k, tolerance)
    return found.select("id", F.transform("x", lambda v: v / F.sqrt("degree")).alias("vec"))


def embedded_clusters(points: DataFrame, edges: DataFrame, k: int, n_init: int = 10, seed: int = 7, tolerance: float = 1e-3) -> DataFrame:
    """``(id, cluster_id)`` by k-means on the spectral coordinates; points without a positive affinity are noise, -1."""
    from conceptlink.operators.clustering import kmeans

    placed = kmeans(written(spectral_embedding(edges, k, tolerance)), k, n_init, seed)
    full = points.select("id").join(placed.select("id", "cluster_id"), "id", "left")
    return full.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(NOISE)))


def laplacian_gaps(edges: DataFrame, count: int = 20, top: int = 5, tolerance: float = 1e-6) -> DataFrame:
    """``(position, eigenvalue, residual, gap, n_clusters)``: the ``count`` smallest eigenvalues of the normalised Laplacian.

    Repeated ones appear as often as they are. ``gap`` is the way to the next one (null for the last), and the ``top`` largest gaps carry the
    number of clusters they suggest.
    """
    _, values, residuals = leading_vectors(edges, count, tolerance)
    gaps = np.diff(values)
    best = set(np.argsort(-gaps, kind="stable")[:top].tolist())
    rows = [(i, float(max(v, 0.0)), float(r), float(gaps[i]) if i < len(gaps) else None, i + 1 if i in best else None) for i, (v, r) in enumerate(zip(values, residuals))]
    return edges.sparkSession.createDataFrame(rows, "position int, eigenvalue double, residual double, gap double, n_clusters int")
