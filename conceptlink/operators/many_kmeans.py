"""Many k-means models at once: one scan of the rows moves all of them a step.

Choosing a number of clusters takes candidates x starts x reference tables. Fitted one
by one, each model scans the rows again for every step. Here a task holds the centres of all
unfinished models, makes the reference rows of its own rows on the fly, and sends
one sum per cluster; a finished model leaves the next scan. What travels is the size
of the models, never of the rows.

A table that fits into a task (``HELD``) is not scanned step by step: the models are dealt out to tasks, and each takes its
own to the end over all rows, comparing only rows whose centre may have changed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.functions import vec as vx
from conceptlink.operators.sampling import subsample
from conceptlink.operators.staging import partition_keys, spread

OWN = -1  # the rows themselves; 0 and up are reference copies
SEED_ROWS = 4096  # rows that starts are drawn from
SLICE = 1 << 22  # distances held at once
ROWS = 8192  # cluster sums a frame holds
CENTERS = 1 << 22  # numbers in the centres of one scan: more models take turns
HELD = 1 << 24  # numbers of a table that a task holds whole
NEAR = 1 << 17  # distances of such a task that stay in the cache


@dataclass(frozen=True)
class Model:
    """One fit: ``k`` centres over the rows (``copy`` -1) or over a reference copy of them."""

    k: int
    start: int = 0
    copy: int = OWN
    centers: np.ndarray | None = None
    cost: float = float("inf")  # squared distances to the centres, summed
    steps: int = 0


_P1, _P2, _P3, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _uniform(keys: np.ndarray, dim: int) -> np.ndarray:
    """Draws from 0 to 1, ``dim`` for each row: Spark's ``xxhash64(..., i)`` of the hash so far and of 0 to dim - 1."""
    i = np.arange(dim, dtype=np.uint64) * _P1
    h = (keys.astype(np.int64).view(np.uint64) + _P5 + np.uint64(4))[:, None] ^ i
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * _P2 + _P3
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    return (h & np.uint64((1 << 52) - 1)).astype(np.float64) / float(1 << 52)


def _with_copies(points: DataFrame, copies: Sequence[int], box: np.ndarray | None, seed: int) -> DataFrame:
    """``vec`` and one hash for every reference copy in use, from which a task draws its row of that copy."""
    hashes = [F.xxhash64(F.lit(seed), F.lit(c), F.col("id")).alias(f"u{c}") for c in copies if c != OWN]
    if hashes and box is None:
        raise ValueError("reference copies need a box")
    return points.select(vx.as_doubles(F.col("vec")).alias("vec"), *hashes)


def _rows_of(pdf: pd.DataFrame, copy: int, box: np.ndarray | None) -> np.ndarray:
    if copy == OWN:
        return np.stack(pdf["vec"].to_numpy())
    return box[0] + _uniform(pdf[f"u{copy}"].to_numpy(), box.shape[1]) * (box[1] - box[0])


def _add_rows(sums: np.ndarray, near: np.ndarray, x: np.ndarray) -> None:
    """Add each row of ``x`` to the sum of its cluster."""
    order = np.argsort(near, kind="stable")
    first = np.flatnonzero(np.diff(near[order], prepend=-1))
    sums[near[order[first]]] += np.add.reduceat(x[order], first, axis=0)


def _spread_starts(x: np.ndarray, ks: Sequence[int], rngs: Sequence[np.random.Generator]) -> list[np.ndarray]:
    """k-means++ for several models of the same rows: each next centre is a row drawn by its squared distance to those before."""
    low = x - x.mean(axis=0)
    squares = (low * low).sum(axis=1)
    least = 1e-13 * squares.sum()  # what is left of the distances of equal rows
    chosen = np.zeros((max(ks), len(ks)), dtype=np.int64)
    chosen[0] = [rng.integers(len(x)) for rng in rngs]
    far = np.full((len(ks), len(x)), np.inf)
    open_ = np.arange(len(ks))
    for step in range(1, max(ks)):
        stay = np.array(ks)[open_] > step
        open_, far = (open_, far) if stay.all() else (open_[stay], far[stay])
        last = chosen[step - 1, open_]
        d = low[last] @ low.T
        d *= -2.0
        d += squares
        d += squares[last][:, None]
        np.minimum(far, np.maximum(d, 0.0, out=d), out=far)
        total = far.sum(axis=1)
        up = np.cumsum(far, axis=1)
        for i, m in enumerate(open_):
            some = total[i] > least
            chosen[step, m] = min(up[i].searchsorted(rngs[m].random() * up[i, -1], side="right"), len(x) - 1) if some else rngs[m].integers(len(x))
    return [x[chosen[:k, i]] for i, k in enumerate(ks)]


def _seed_rows(points: DataFrame, models: Sequence[Model], box: np.ndarray | None, seed: int) -> pd.DataFrame:
    """``SEED_ROWS`` hashed rows (or as many as the largest model has centres) that starts are drawn from."""
    most = max(m.k for m in models)
    chosen = subsample(points.select("id", "vec"), max(SEED_ROWS, most), ["id"], seed).orderBy("id")
    pdf = _with_copies(chosen, sorted({m.copy for m in models}), box, seed).toPandas()
    if len(pdf) < most:
        raise ValueError(f"{len(pdf)} rows are too few for {most} clusters")
    return pdf


def _starts(pdf: pd.DataFrame, models: Sequence[Model], box: np.ndarray | None, seed: int) -> list[Model]:
    found = list(models)
    for copy in sorted({m.copy for m in models}):
        mine = [i for i, m in enumerate(models) if m.copy == copy]
        rngs = [np.random.default_rng((seed, models[i].k, models[i].start, copy + 1)) for i in mine]
        for i, centers in zip(mine, _spread_starts(_rows_of(pdf, copy, box), [models[i].k for i in mine], rngs)):
            found[i] = replace(models[i], centers=centers)
    return found


def _started(points: DataFrame, models: Sequence[Model], box: np.ndarray | None, seed: int, dim: int) -> list[Model]:
    """Starts drawn from the seed rows."""
    return _starts(_seed_rows(points, models, box, seed), models, box, seed)


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and its squared distance, in slices of bounded size."""
    step = max(1, SLICE // len(centers))
    near = np.empty(len(x), dtype=np.int64)
    far = np.empty(len(x))
    own = (centers * centers).sum(axis=1)
    for a in range(0, len(x), step):
        part = x[a : a + step]
        near[a : a + step] = (own - 2.0 * (part @ centers.T)).argmin(axis=1)
        far[a : a + step] = ((part - centers[near[a : a + step]]) ** 2).sum(axis=1)
    return near, far


def _two_nearest(x: np.ndarray, low: np.ndarray, squares: np.ndarray, centers: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre of each of the ``rows`` (all unless given), at most how far it is, and at least how far the others are.

    ``low`` are the rows in single precision: their products decide wherever the two nearest differ by more than rounding may
    have made of them, and full ones decide the rest.
    """
    many = len(x) if rows is None else len(rows)
    taken = squares if rows is None else squares[rows]
    step = max(1, NEAR // len(centers))
    own = (centers * centers).sum(axis=1)
    turned, own_low = (-2.0 * centers.T).astype(np.float32), own.astype(np.float32)
    wide = (centers.shape[1] + 8) * 2.0**-23 * (np.sqrt(taken) + np.sqrt(own.max())) ** 2
    near, first, second = np.empty(many, dtype=np.int64), np.empty(many), np.empty(many)
    for a in range(0, many, step):
        rough = (low[a : a + step] if rows is None else low[rows[a : a + step]]) @ turned
        rough += own_low
        near[a : a + step] = best = rough.argmin(axis=1)
        at = np.arange(len(rough))
        first[a : a + step] = rough[at, best]
        rough[at, best] = np.inf
        second[a : a + step] = rough.min(axis=1)
    doubt = np.flatnonzero(~(second - first > 2 * wide))
    for a in range(0, len(doubt), step):
        here = doubt[a : a + step]
        near[here] = (own - 2.0 * (x[here if rows is None else rows[here]] @ centers.T)).argmin(axis=1)
    second[doubt] = first[doubt]
    return near, np.sqrt(np.maximum(first + 2 * wide + taken, 0.0)), np.sqrt(np.maximum(second - wide + taken, 0.0))


def _at_most(low: np.ndarray, squares: np.ndarray, centers: np.ndarray, near: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """At most how far each of the ``rows`` is from its centre, in single precision."""
    held, step = centers.astype(np.float32), max(1, NEAR // centers.shape[1])
    out = np.empty(len(rows))
    for a in range(0, len(rows), step):
        here = rows[a : a + step]
        d = low[here] - held[near[here]]
        out[a : a + step] = np.einsum("ij,ij->i", d, d)
    rounding = 2.0**-22 * (np.sqrt(squares[rows]) + np.sqrt((centers * centers).sum(axis=1).max()))
    return np.sqrt(out) * (1 + (centers.shape[1] + 8) * 2.0**-23) + rounding


def _fit_held(x: np.ndarray, centers: np.ndarray, max_iter: int, tol: float, low: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Centres, cost and steps of one model over all rows.

    A row is compared anew when the centres' moves since its last comparison may have brought another one nearer than its own.
    """
    k, steps = len(centers), 0
    near, upper, lower = _two_nearest(x, low, squares, centers)
    size, sums = np.bincount(near, minlength=k).astype(float), np.zeros(centers.shape)
    _add_rows(sums, near, x)
    share = 1.0  # of the rows in question that are still so after their own distance is measured
    while True:
        moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1.0)[:, None], centers)
        far = np.sqrt(((moved - centers) ** 2).sum(axis=1))
        steps += 1
        if far.max() <= tol or steps > max_iter:
            break
        centers = moved
        top = int(far.argmax())
        upper += far[near]
        lower -= np.where(near == top, np.partition(far, -2)[-2] if k > 1 else 0.0, far[top])
        rows = np.flatnonzero(upper >= lower)
        if len(rows) and (share < 0.7 or steps % 8 == 0):
            upper[rows] = _at_most(low, squares, centers, near, rows)
            left = rows[upper[rows] >= lower[rows]]
            share, rows = len(left) / len(rows), left
        if not len(rows):
            continue
        old = near[rows]
        near[rows], upper[rows], lower[rows] = _two_nearest(x, low, squares, centers, None if len(rows) == len(x) else rows)
        other = np.flatnonzero(old != near[rows])
        if len(other):
            gone = np.zeros(sums.shape)
            _add_rows(gone, old[other], x[rows[other]])
            _add_rows(sums, near[rows[other]], x[rows[other]])
            sums -= gone
            size = np.bincount(near, minlength=k).astype(float)
    step = max(1, SLICE // centers.shape[1])
    cost = sum(float(((x[a : a + step] - centers[near[a : a + step]]) ** 2).sum()) for a in range(0, len(x), step))
    return centers, cost, steps


def _fit_whole(points: DataFrame, models: Sequence[Model], box: np.ndarray | None, max_iter: int, tol: float, seed: int, dim: int) -> list[Model]:
    """All models, each in one task. A task gets the rows for the models of one copy, or of a reference copy their hashes alone."""
    spark = points.sparkSession
    copies = sorted({m.copy for m in models})
    parts = -(-spark.sparkContext.defaultParallelism * (4 if len(copies) > 1 else 1) // len(copies))
    slots: list[tuple[int, list[int]]] = []
    for copy in copies:
        mine = sorted((i for i, m in enumerate(models) if m.copy == copy), key=lambda i: -models[i].k)
        slots += [(copy, mine[a::parts]) for a in range(min(parts, len(mine)))]
    keys = partition_keys(spark, len(slots))
    dealt = dict(zip(keys, slots))
    shared = spark.sparkContext.broadcast((_seed_rows(points, models, box, seed), [replace(m, centers=None) for m in models], dealt))

    def asked(copy: int, *fields) -> DataFrame:
        to = F.explode(F.array(*[F.lit(key) for key, (c, _) in dealt.items() if c == copy]))
        return points.select(*fields, to.alias("slot"))

    vec = vx.as_doubles(F.col("vec")).alias("vec")
    frames = [asked(c, F.lit(None).cast("long").alias("h"), vec) for c in copies if c == OWN]
    for c in copies:
        if c != OWN:
            if box is None:
                raise ValueError("reference copies need a box")
            hashed = F.xxhash64(F.lit(seed), F.lit(c), F.col("id")).alias("h")
            frames.append(asked(c, hashed, F.lit(None).cast("array<double>").alias("vec")))
    frame = frames[0]
    for other in frames[1:]:
        frame = frame.unionByName(other)

    def run(table: pa.Table) -> pa.Table:
        seeds, all_models, own = shared.value
        copy, mine = own[table["slot"][0].as_py()]
        if copy == OWN:
            x = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        else:
            h = table["h"].to_numpy()
            x = np.empty((len(h), dim))
            for a in range(0, len(h), ROWS):
                x[a : a + ROWS] = box[0] + _uniform(h[a : a + ROWS], dim) * (box[1] - box[0])
        middle = x.mean(axis=0)
        x = x - middle
        low, squares = x.astype(np.float32), (x * x).sum(axis=1)
        fits = [_fit_held(x, m.centers - middle, max_iter, tol, low, squares) for m in _starts(seeds, [all_models[i] for i in mine], box, seed)]
        centers = [(c + middle).reshape(-1) for c, _, _ in fits]
        return pa.table(
            {
                "model": pa.array(mine, pa.int32()),
                "cost": pa.array([cost for _, cost, _ in fits], pa.float64()),
                "steps": pa.array([steps for _, _, steps in fits], pa.int32()),
                "centers": pa.array(centers, pa.list_(pa.float64())),
            }
        )

    try:
        groups = frame.repartition(len(slots), "slot").groupBy("slot")
        found = groups.applyInArrow(run, "model int, cost double, steps int, centers array<double>").toArrow()
    finally:
        shared.destroy()
    fits = list(models)
    for i, cost, steps, centers in zip(*(found[c] for c in ("model", "cost", "steps", "centers"))):
        m = models[i.as_py()]
        flat = centers.values.to_numpy(zero_copy_only=False)
        fits[i.as_py()] = replace(m, centers=flat.reshape(m.k, dim), cost=cost.as_py(), steps=steps.as_py())
    return fits


def _used(n: list[np.ndarray], s: list[np.ndarray], **more: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    """Rows of the clusters in use, of many models in one frame."""
    model = np.repeat(np.arange(len(n)), [len(c) for c in n])
    cluster = np.concatenate([np.arange(len(c)) for c in n])
    size, sums = np.concatenate(n), np.concatenate(s)
    extra = {name: np.concatenate(parts) for name, parts in more.items()}
    used = np.flatnonzero(size)
    for a in range(0, len(used), ROWS):
        at = used[a : a + ROWS]
        frame = {"model": model[at], "cluster": cluster[at], "n": size[at], **{name: v[at] for name, v in extra.items()}}
        yield pd.DataFrame({**frame, "s": list(sums[at])})


def _scan(points: DataFrame, models: Sequence[Model], box: np.ndarray | None, seed: int, dim: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Size and vector sum of every cluster, and the cost, of every model, in one pass."""
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast([(m.copy, m.centers) for m in models])
    frame = _with_copies(points, sorted({m.copy for m in models}), box, seed)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        n = [np.zeros(len(c)) for _, c in held]
        s = [np.zeros(c.shape) for _, c in held]
        cost = np.zeros(len(held))
        for pdf in batches:
            if pdf.empty:
                continue
            rows: dict[int, np.ndarray] = {}
            for i, (copy, centers) in enumerate(held):
                if copy not in rows:
                    rows[copy] = _rows_of(pdf, copy, box)
                x = rows[copy]
                near, far = _nearest(x, centers)
                n[i] += np.bincount(near, minlength=len(centers))
                _add_rows(s[i], near, x)
                cost[i] += far.sum()
        # a model's cost goes with its first cluster in use
        shares = [np.where(np.arange(len(c)) == np.argmax(c > 0), v, 0.0) for c, v in zip(n, cost)]
        yield from _used(n, s, cost=shares)

    parts = frame.mapInPandas(step, "model int, cluster int, n double, cost double, s array<double>")
    totals = parts.groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s")
    )
    try:
        found = totals.toArrow()
    finally:
        shared.destroy()
    model, cluster, n, cost = (found[c].to_numpy() for c in ("model", "cluster", "n", "cost"))
    sums = found["s"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    out = []
    for i, m in enumerate(models):
        mine = model == i
        size, total = np.zeros(m.k), np.zeros((m.k, dim))
        size[cluster[mine]], total[cluster[mine]] = n[mine], sums[mine]
        out.append((size, total, float(cost[mine].sum())))
    return out


def _turns(models: Sequence[Model], dim: int) -> Iterator[list[int]]:
    """Indices of models whose centres fit into one scan together."""
    turn: list[int] = []
    held = 0
    for i, m in enumerate(models):
        if turn and held + m.k * dim > CENTERS:
            yield turn
            turn, held = [], 0
        turn.append(i)
        held += m.k * dim
    if turn:
        yield turn


def fit_many(
    points: DataFrame, models: Sequence[Model], box: np.ndarray | None = None, max_iter: int = 100, tol: float = 1e-4, seed: int = 7
) -> list[Model]:
    """All ``models`` fitted over ``(id, vec)``; ``box`` holds the low and high corner of reference copies.

    A model is finished when no centre moves farther than ``tol``, or after ``max_iter`` steps; its cost is that of its final
    centres. An emptied cluster keeps its centre. Equal rows are fine; fewer rows than clusters raise.
    """
    dim = len(points.select("vec").first()["vec"])
    if points.count() * dim <= HELD:
        return _fit_whole(points, models, box, max_iter, tol, seed, dim)
    fits = _started(points, models, box, seed, dim)
    for turn in _turns(fits, dim):
        open_ = list(turn)
        while open_:
            for i, (size, total, cost) in zip(open_, _scan(points, [fits[j] for j in open_], box, seed, dim)):
                m = fits[i]
                moved = np.where(size[:, None] > 0, total / np.maximum(size, 1.0)[:, None], m.centers)
                shift = float(((moved - m.centers) ** 2).sum(axis=1).max())
                done = shift <= tol * tol or m.steps >= max_iter
                fits[i] = replace(m, centers=m.centers if done else moved, cost=cost if done else float("inf"), steps=m.steps + 1)
            open_ = [i for i in open_ if not np.isfinite(fits[i].cost)]
    return fits


def best_fits(fits: Sequence[Model]) -> dict[tuple[int, int], Model]:
    """The start of lowest cost for every ``(k, copy)``."""
    best: dict[tuple[int, int], Model] = {}
    for m in fits:
        held = best.get((m.k, m.copy))
        if held is None or m.cost < held.cost:
            best[m.k, m.copy] = m
    return best


def mean_silhouettes(points: DataFrame, fits: Sequence[Model]) -> list[float]:
    """Mean silhouette (squared Euclidean, every row) of each model of the rows, in two scans for all models.

    The mean squared distance of a row to a cluster follows from the cluster's size, vector sum
    and sum of squares. A row alone in its cluster counts as zero.
    """
    spark = points.sparkSession
    dim = len(points.select("vec").first()["vec"])
    frame = points.select(vx.as_doubles(F.col("vec")).alias("vec"))
    scores: list[float] = []
    for turn in _turns(fits, dim):
        held = [fits[i].centers for i in turn]
        shared = spark.sparkContext.broadcast(held)

        def sums(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            centers = shared.value
            n = [np.zeros(len(c)) for c in centers]
            q = [np.zeros(len(c)) for c in centers]
            s = [np.zeros(c.shape) for c in centers]
            for pdf in batches:
                if not pdf.empty:
                    x = np.stack(pdf["vec"].to_numpy())
                    for i, c in enumerate(centers):
                        near, _ = _nearest(x, c)
                        n[i] += np.bincount(near, minlength=len(c))
                        q[i] += np.bincount(near, weights=(x * x).sum(axis=1), minlength=len(c))
                        _add_rows(s[i], near, x)
            yield from _used(n, s, q=q)

        parts = frame.mapInPandas(sums, "model int, cluster int, n double, q double, s array<double>")
        totals = parts.groupBy("model", "cluster").agg(
            F.sum("n").alias("n"), F.sum("q").alias("q"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s")
        )
        table = totals.orderBy("model", "cluster").toPandas()
        summary = [(g["cluster"].to_numpy(), g["n"].to_numpy(), g["q"].to_numpy(), np.stack(g["s"].to_numpy())) for _, g in table.groupby("model")]
        known = spark.sparkContext.broadcast(summary)

        def score(batches: Iterator[pd.DataFrame], shared=shared, known=known) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if pdf.empty:
                    continue
                whole = np.stack(pdf["vec"].to_numpy())
                for i, (centers, (ids, n, q, s)) in enumerate(zip(shared.value, known.value)):
                    total = 0.0
                    step = max(1, SLICE // len(centers))
                    for a in range(0, len(whole), step):
                        x = whole[a : a + step]
                        own = np.searchsorted(ids, _nearest(x, centers)[0])
                        at = np.arange(len(x))
                        far = (x * x).sum(axis=1)[:, None] * n - 2.0 * x @ s.T + q
                        inner = far[at, own] / np.maximum(n[own] - 1, 1)
                        means = far / n
                        means[at, own] = np.inf
                        outer = means.min(axis=1)
                        top = np.maximum(inner, outer)
                        fine = (n[own] > 1) & np.isfinite(outer) & (top > 0)
                        total += float(np.where(fine, (outer - inner) / np.where(top > 0, top, 1.0), 0.0).sum())
                    yield pd.DataFrame({"model": [i], "total": [total], "n": [len(whole)]})

        found = frame.mapInPandas(score, "model int, total double, n long").groupBy("model").agg((F.sum("total") / F.sum("n")).alias("v"))
        by_model = {r["model"]: r["v"] for r in found.collect()}
        shared.destroy()
        known.destroy()
        scores += [by_model[i] for i in range(len(held))]
    return scores


def scan_numbers(points: DataFrame, candidates: Sequence[int], n_init: int = 10, seed: int = 7) -> DataFrame:
    """``(k, cost, silhouette)`` of the best of ``n_init`` starts for every candidate number of clusters from 2 up."""
    base = spread(points.select("id", "vec")).persist()  # a table in few files would keep most cores idle
    try:
        best = best_fits(fit_many(base, [Model(k, s) for k in candidates for s in range(n_init)], seed=seed))
        fits = [best[k, OWN] for k in candidates]
        rows = [(int(m.k), m.cost, v) for m, v in zip(fits, mean_silhouettes(base, fits))]
    finally:
        base.unpersist()
    return points.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def gap_scan(
    points: DataFrame,
    candidates: Sequence[int],
    references: int = 15,
    form: str = "inertia",
    unit_box: bool = False,
    n_init: int = 1,
    seed: int = 7,
) -> DataFrame:
    """``(k, gap, s_k, log_w, log_w_ref)`` as ``clustering.gap_statistic`` defines it, all models fitted together.

    References are uniform in the data's bounding box or the unit cube, one row for every row of the data.
    """
    from conceptlink.operators.summaries import bounding_box

    dim = len(points.select("vec").first()["vec"])
    if unit_box:
        box = np.stack([np.zeros(dim), np.ones(dim)])
    else:
        sides = bounding_box(points).orderBy("dim").collect()
        box = np.array([[r["low"] for r in sides], [r["high"] for r in sides]])
    base = spread(points.select("id", "vec")).persist()  # a table in few files would keep most cores idle
    try:
        asked = [Model(k, s, c) for k in candidates for c in range(-1, references) for s in range(n_init if k > 1 else 1)]
        best = best_fits(fit_many(base, asked, box, seed=seed))
    finally:
        base.unpersist()
    tiny = np.finfo(float).tiny
    rows = []
    for k in candidates:
        w = np.log(max(best[k, OWN].cost, tiny))
        costs = np.maximum([best[k, c].cost for c in range(references)], tiny)
        logs = np.log(costs)
        expected = float(np.log(costs.mean()) if form == "inertia" else logs.mean())
        rows.append((int(k), expected - float(w), float(logs.std() * np.sqrt(1.0 + 1.0 / references)), float(w), expected))
    return points.sparkSession.createDataFrame(rows, "k int, gap double, s_k double, log_w double, log_w_ref double")
