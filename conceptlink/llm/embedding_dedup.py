"""Near-equal vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.operators.components import connected_components
from conceptlink.operators.staging import written

_BLOCK = 1024  # vectors of one bucket that are compared with as many others in one go
_NEAR = 2  # coordinates tried per rotation


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x


def probes(x: np.ndarray, tables: int, hashes: int, seed: int = 7) -> np.ndarray:
    """Buckets of each row, (rows, tables, probes), the own bucket first.

    A rotation is three rounds of random signs and a Hadamard transform. The hash is the signed axis nearest to the
    rotated vector; the second nearest is the other probe. A bucket joins ``hashes`` of them, so there are 2**hashes
    probes.
    """
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    base = np.zeros((len(x), width))
    base[:, : x.shape[1]] = x / np.abs(x).max(axis=1, keepdims=True)
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = np.zeros((len(x), tables, _NEAR**hashes), np.int64)
    for t in range(tables):
        code = np.zeros((len(x), 1), np.int64)
        for h in range(hashes):
            y = base
            for s in signs[t, h]:
                y = hadamard(y * s)
            axis = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :_NEAR]
            signed = 2 * axis + (np.take_along_axis(y, axis, axis=1) < 0)
            code = (code[:, :, None] * (2 * width) + signed[:, None, :]).reshape(len(x), -1)
        out[:, t] = code
    return out


def _place(tables: int, hashes: int):
    """One row per vector, table and probe, with the vector and all its probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                batch = whole.slice(s, 256)
                vectors = batch.column("vec").to_pylist()
                for dim in sorted({len(v) for v in vectors}):
                    rows = np.array([i for i, v in enumerate(vectors) if len(v) == dim])
                    x = np.array([vectors[i] for i in rows], float)
                    code = probes(x, tables, hashes)
                    n, reps = len(rows), tables * code.shape[2]
                    pick = pa.array(np.repeat(rows, reps))
                    raw = [v.tobytes() for v in x]
                    own = [c.tobytes() for c in code]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("label").take(pick),
                            pa.array(np.full(n * reps, dim, np.int32)),
                            pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), code.shape[2]), n)),
                            pa.array(code.reshape(-1)),
                            pa.array(np.tile(np.arange(code.shape[2]) == 0, n * tables)),
                            batch.column("u").take(pick),
                            batch.column("copies").take(pick),
                            pa.array(raw, pa.binary()).take(pa.array(np.repeat(np.arange(n), reps))),
                            pa.array(own, pa.binary()).take(pa.array(np.repeat(np.arange(n), reps))),
                        ],
                        ["label", "dim", "t", "bucket", "home", "u", "copies", "x", "probes"],
                    )

    return run


def _compare(tables: int, hashes: int, least: float):
    """Links within each block of a bucket: how many each vector has, and a forest that connects them.

    A pair may meet in several buckets; it is counted in the first of them only, which both rows' probes tell.
    """
    width = _NEAR**hashes

    def block(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        t, bucket = rows[0][2], rows[0][3]
        side, home, u, copies = (np.array([r[k] for r in rows]) for k in (6, 7, 8, 9))
        x = np.stack([np.frombuffer(r[10]) for r in rows])
        code = np.stack([np.frombuffer(r[11], np.int64) for r in rows]).reshape(len(rows), tables, width)
        norm = np.sqrt((x * x).sum(axis=1))
        links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for s in range(0, len(rows), 256):
            e = min(s + 256, len(rows))
            cos = (x[s:e] @ x.T) / (norm[s:e, None] * norm[None, :])
            ok = (cos >= least) & (np.arange(len(rows))[None, :] > np.arange(s, e)[:, None])
            ok &= home[s:e, None] | home[None, :]
            ok &= (side[s:e, None] < 0) | (side[s:e, None] != side[None, :])
            a, b = np.nonzero(ok)
            a = a + s
            for k in range(0, len(a), 1 << 15):
                i, j = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
                first = np.ones(len(i), bool)
                for q in range(t + 1):
                    at_i = (code[j, q] == code[i, q, :1]).any(axis=1)
                    at_j = (code[i, q] == code[j, q, :1]).any(axis=1)
                    if q < t:
                        first &= ~(at_i | at_j)
                    else:
                        meet = np.where(at_i & at_j, np.minimum(code[i, q, 0], code[j, q, 0]), np.where(at_i, code[i, q, 0], code[j, q, 0]))
                        first &= meet == bucket
                i, j = i[first], j[first]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                while True:  # smallest index wins until every link joins equal roots
                    low = np.minimum(root[i], root[j])
                    if not len(i) or (root[i] == root[j]).all():
                        break
                    np.minimum.at(root, root[i], low)
                    np.minimum.at(root, root[j], low)
                    while (root[root] != root).any():
                        root = root[root]
        for r in np.flatnonzero((links > 0) | (root != np.arange(len(rows)))):
            yield int(u[r]), int(links[r]), int(u[root[r]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "dim", "t", "bucket", "i", "j", "side", "home", "u", "copies", "x", "probes"]
        held: list[tuple] = []

        def give():
            out = list(block(held)) if len(held) > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "links", "root"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if held and row[:6] != held[0][:6]:
                    yield from give()
                    held = []
                held.append(row)
        yield from give()

    return run


def near_vectors(vectors: DataFrame, least: float = 0.98, tables: int = 8, hashes: int = 2) -> DataFrame:
    """Links of cosine ``least`` or more among ``vectors`` (vec_id, embedding, label, ...) of equal label.

    Returns per row vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable by links, itself
    included) and kept (vec_id = component_id).

    A row without vec_id or label, or whose vector is null, empty, zero or holds a null or non-finite number, links with
    nothing. Vectors of different length never link. Rows that repeat a vec_id are vectors of their own. An
    empty table gives none.

    Equal vectors are folded and counted first. The rest meet in buckets of ``tables`` tables, each vector in
    2**``hashes`` of each; pairs with one of them at home are compared in double precision. Large buckets are
    compared block by block. A task gives out counts and a spanning forest, never its pairs. The share of links found is
    a matter of ``tables``: a pair is missed only if it misses in all. ``hashes`` should grow with the rows per label.
    """
    numbers = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    good &= F.forall(numbers, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(numbers, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", numbers.alias("vec"), F.coalesce(good, F.lit(False)).alias("good"))
    folded = rows.filter("good").groupBy("label", "vec").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    distinct = written(folded.withColumn("u", F.monotonically_increasing_id()))

    label = distinct.schema["label"].dataType.simpleString()
    place = f"label {label}, dim int, t int, bucket long, home boolean, u long, copies long, x binary, probes binary"
    key = ["label", "dim", "t", "bucket"]
    placed = distinct.select("label", "vec", "u", "copies").mapInArrow(_place(tables, hashes), place)
    sizes = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("any"))
    sizes = written(sizes.filter("size > 1 and any").drop("any"))
    dealt = (
        placed.join(sizes, key)
        .withColumn("blocks", F.ceil(F.col("size") / _BLOCK).cast("long"))
        .withColumn("own", F.pmod(F.xxhash64("u"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("i") == F.col("j"), F.lit(-1).cast("long")).otherwise(F.col("own")))
        .select(*key, "i", "j", "side", "home", "u", "copies", "x", "probes")
    )
    by = [*key, "i", "j"]
    found = written(dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(_compare(tables, hashes, least), "u long, links long, root long"))

    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    edges = found.filter("u <> root").select(F.col("u").alias("src"), F.col("root").alias("dst"))
    groups = connected_components(distinct.select(F.col("u").alias("id")), edges).withColumnRenamed("id", "u")
    named = written(distinct.join(groups, "u").join(counts, "u", "left"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    info = named.join(lowest, "component").select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("good"))
    out = rows.join(info, ["label", "vec", "good"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
