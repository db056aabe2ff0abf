"""Embedding whitening by shifted CholeskyQR: Gram passes over the rows, triangular factors in the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_ROWS = 4096  # vectors held as numbers at once
_FIT = 1 << 62  # whole numbers below this are reckoned in 64 bits
_SETTLED = 1e-10  # the Gram matrix may differ this much from the identity
_NOTHING = 1e-12  # a component whose deviation is this share of the largest is rounding


@dataclass(frozen=True)
class Whitening:
    """What every task needs: a few arrays of the width of a vector, whatever the number of rows."""

    n: int
    sums: list[int]
    components: np.ndarray  # one row each, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float


def _numbers(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their entries as whole numbers x = floor(64 c) + 1000000, one row a vector."""
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        flat = part.column("vec").flatten().to_numpy(zero_copy_only=False)
        scaled = np.clip(np.floor(64.0 * flat), -float(_FIT), float(_FIT))
        yield part, scaled.astype(np.int64).reshape(part.num_rows, -1) + 1_000_000


def _sum_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sum per dimension of a task, exact."""
    n, total = 0, None
    for batch in batches:
        for part, x in _numbers(batch):
            small = np.abs(x).max(initial=0) < _FIT // _ROWS
            sums = (x if small else x.astype(object)).sum(axis=0).astype(object)
            n, total = n + len(x), sums if total is None else total + sums
    if n:
        cols = [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(cols, ["dim", "n", "total"])


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: in 64 bits where that is enough, else in Python's whole numbers."""
    if int(np.abs(x).max(initial=0)) * n < _FIT and max(map(abs, sums), default=0) < _FIT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular factor, by substitution."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(rows: DataFrame, dim: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of outer products of what ``make`` gives for the rows' numbers; tasks give out one matrix each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, x in _numbers(batch):
                q = make(x)
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    parts = rows.select("vec").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _column_means(rows: DataFrame, dim: int, n: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim)
        for batch in batches:
            for _, x in _numbers(batch):
                total += make(x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total)], ["i", "v"])

    out = np.zeros(dim)
    for r in rows.select("vec").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"] / n
    return out


def clean_rows(vectors: DataFrame) -> DataFrame:
    """vec_id and ``vec`` (doubles) of the rows that can be whitened: see :func:`whiten`."""
    vec = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & (F.size(vec) > 0)
    good &= F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(good)
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    return rows.filter(F.size("vec") == (common["dim"] if common else 0))


def fit(rows: DataFrame, most: int = 32) -> Whitening | None:
    """Whitening components of clean rows (vec_id, vec); None without any row.

    The centred rows are Q R. A Gram pass gives Q'Q; its Cholesky factor, shifted as long as the matrix is far from the
    identity, orthogonalises the rows further by one more triangular solve, and multiplies onto R. After two or three passes Q'Q
    is the identity but for rounding, and the singular values and vectors of R are those of the rows. Nothing squares the
    condition number of the data. What is left of Q'Q is multiplied in, so that rows of lower rank than their width are right too.
    """
    sums = sorted(rows.select("vec").mapInArrow(_sum_columns, "dim int, n long, total decimal(38,0)").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    if not sums:
        return None
    n, totals, dim = sums[0]["n"], [int(r["total"]) for r in sums], len(sums)
    factors: list[np.ndarray] = []

    def make(x: np.ndarray) -> np.ndarray:
        q = (_spread(x, n, totals) / n).astype(float)
        for r in factors:
            q = solve(q, r)
        return q

    trace, left = 0.0, None
    for turn in range(12):
        gram = _gram(rows, dim, make)
        gram = (gram + gram.T) / 2
        if not turn:
            trace = float(np.trace(gram)) / n
            if not trace:
                return Whitening(n, totals, np.zeros((0, dim)), np.zeros(0), 0.0)
        values, vectors = np.linalg.eigh(gram)
        off = np.minimum(np.abs(values - 1), np.abs(values))
        left = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
        if turn and off.max() < _SETTLED:
            break
        near = np.abs(values - 1).max() < 0.5
        shift = 0.0 if near else 11 * (n * dim + dim * (dim + 1)) * 2.0**-53 * float(values[-1])
        factors.append(np.linalg.cholesky(gram + shift * np.eye(dim)).T)
    whole = np.eye(dim)
    for r in factors:
        whole = r @ whole
    _, singular, right = np.linalg.svd(left @ whole)
    some = int((singular[:most] > singular[0] * _NOTHING).sum())
    return Whitening(n, totals, right[:some], singular[:some] ** 2 / n, trace)


def _project(w: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    scale = np.sqrt(w.eigenvalues)

    def make(x: np.ndarray) -> np.ndarray:
        return (_spread(x, w.n, w.sums) / w.n).astype(float) @ w.components.T / scale

    return make


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, by one more pass over all rows."""
    k, project = len(w.components), _project(w)
    means = _column_means(rows, k, w.n, project)
    return float(np.abs(_gram(rows, k, lambda x: project(x) - means) / w.n - np.eye(k)).max())


def whiten(vectors: DataFrame, most: int = 32) -> DataFrame:
    """Whitened coordinates of ``vectors`` (vec_id, embedding, ...), one row for each vector and component.

    An entry c counts as x = floor(64 c) + 1000000. The fit list is all rows returned. Columns: vec_id, component (from 1, by
    falling eigenvalue, at most ``most``), n (rows of the fit list), deviation (sum over dimensions of (n x - S)^2, exact; null
    where it exceeds a long), whitened, explained (share of the variance) and identity_error.

    Rows whose vector is null or empty, or holds a null or non-finite entry, are dropped, and so are vectors of another length
    than the most frequent one (the longest of several). Repeated rows and rows without vec_id count like all others. Equal
    eigenvalues have any basis of their space; directions without variance give no component, so equal vectors and a
    single one give no row. An empty table gives none. Entries beyond 2**62 / 64 count as that.

    Every pass is one scan: a task holds a slice of its rows and one square matrix of their width, and gives that out. Only such
    matrices reach the driver. Nothing but the rows' own passes is shuffled, and no intermediate table is written.
    """
    rows = clean_rows(vectors)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    w = fit(rows, most)
    if w is None or not len(w.components):
        return rows.sparkSession.createDataFrame([], kind)
    error, project, k = identity_error(rows, w), _project(w), len(w.components)
    explained = w.eigenvalues / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _numbers(batch):
                m, far = len(x), _spread(x, w.n, w.sums)
                if far.dtype == object or float(np.abs(far).max(initial=0)) ** 2 * far.shape[1] >= _FIT:
                    exact = (far.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([int(d) if d < 1 << 63 else None for d in exact], pa.int64())
                else:
                    deviation = pa.array((far * far).sum(axis=1))
                pick = pa.array(np.repeat(np.arange(m), k))
                cols = [
                    part.column("vec_id").take(pick),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)),
                    deviation.take(pick),
                    pa.array(project(x).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, kind)
