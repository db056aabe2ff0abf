"""Reading, batching and hashing helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = 4096

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: spreads every input bit over the word."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE = mix(np.arange(1, 257, dtype=U64))  # a random-looking word for each byte value


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


_POW = powers(_POWERS)


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in column ``name``, not copied.

    What is made of a slice can be freed before the next one, so a task holds the Python form of a slice and not of the
    whole batch. A longer value stands alone.
    """
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as empty."""
    return [v or b"" for v in batch.column(name).cast(pa.binary()).to_pylist()]


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run [start, end) of ``buf``; runs are in order, disjoint and not empty."""
    if not len(starts):
        return np.empty(0, U64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    off = np.arange(int(lens.sum())) - np.repeat(first, lens)
    values = BYTE[buf[off + np.repeat(starts, lens)]] * _POW[off % _POWERS]
    return mix(np.add.reduceat(values, first) + lens.astype(U64) * U64(BASE))


class Words:
    """Lower-cased (A-Z) words of a list of documents: hash, byte range and document of each, in order."""

    def __init__(self, docs: list[bytes]):
        buf = np.frombuffer(b" ".join(docs) + b" ", np.uint8)
        gap = SPACE[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first_byte = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])[:-1])).astype(np.int64)
        self.doc = np.searchsorted(self.first_byte, self.start, side="right") - 1
        self.hash = run_hashes(LOWER[buf], self.start, self.end)
        # words of document i are the slice bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.doc, np.arange(len(docs) + 1))


def combine(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of a sequence of hashes; depends on their order and number."""
    out = np.full(len(columns[0]), len(columns), U64)
    for c in columns:
        out = out * U64(BASE) + c
    return mix(out)


def shingle_sets(docs: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each document.

    Fewer than k words give one shingle of all of them; no word gives the empty set.
    """
    w = Words(docs)
    n = len(w.hash)
    rolled = combine([w.hash[i : n - k + 1 + i] for i in range(k)]) if n >= k else np.empty(0, U64)
    out = []
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            out.append(combine([w.hash[i : i + 1] for i in range(a, b)]))
        else:
            out.append(np.empty(0, U64))
    return out
