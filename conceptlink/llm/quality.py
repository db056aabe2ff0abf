"""Byte-level convolutional quality classifier, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import slices, texts

WIDTH, STRIDE, DIM, FILTERS = 8, 2, 4, 16
HALF = 32  # filter positions in half a chunk; chunks overlap by one half
_BLOCK = 2048 * HALF * STRIDE  # bytes convolved at once
PAD = 256


@dataclass
class Network:
    """Byte embedding, filters, and the weights that combine the pooled responses."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: np.ndarray

    @staticmethod
    def start(seed: int) -> Network:
        r = np.random.default_rng(seed)
        f = np.float32
        return Network(
            r.normal(0, 0.5, (257, DIM)).astype(f),
            r.normal(0, 0.35, (WIDTH * DIM, FILTERS)).astype(f),
            np.zeros(FILTERS, f),
            r.normal(0, 0.1, 3 * FILTERS).astype(f),
            np.zeros(1, f),
        )

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.offset]

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Filter responses of a padded run of byte codes, by half chunk and position; before bias and rectifier."""
        x = self.embed.take(codes, axis=0)
        steps = (len(codes) - WIDTH) // STRIDE + 1
        windows = np.lib.stride_tricks.as_strided(x, (steps, WIDTH * DIM), (STRIDE * DIM * 4, 4))
        y = np.empty((-(-steps // HALF) * HALF, FILTERS), np.float32)
        np.matmul(np.ascontiguousarray(windows), self.filters, out=y[:steps])
        y[steps:] = -np.inf
        return y.reshape(-1, HALF, FILTERS)

    def pooled(self, largest: np.ndarray) -> np.ndarray:
        return np.maximum(largest + self.bias, 0)

    def chunks(self, doc: bytes) -> np.ndarray:
        """Pooled responses of all overlapping chunks of a document of any length."""
        codes = padded(doc)
        found = [
            self.responses(codes[a : a + _BLOCK + WIDTH - STRIDE]).max(axis=1)
            for a in range(0, len(codes) - WIDTH + STRIDE, _BLOCK)
            if len(codes) - a >= WIDTH
        ]
        return self.pooled(overlapped(np.concatenate(found)))

    def score(self, doc: bytes) -> float:
        pooled = self.chunks(doc)
        return float(sigmoid(combined(pooled) @ self.out + self.offset[0]))


def padded(doc: bytes) -> np.ndarray:
    codes = np.frombuffer(doc, np.uint8).astype(np.int64)
    short = max(WIDTH - len(codes), (len(codes) - WIDTH) % STRIDE)
    return np.concatenate([codes, np.full(short, PAD)])


def overlapped(halves: np.ndarray) -> np.ndarray:
    return np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves


def combined(pooled: np.ndarray) -> np.ndarray:
    """What a document's chunks say together: the mean, largest and smallest of each pooled response."""
    return np.concatenate([pooled.mean(axis=0), pooled.max(axis=0), pooled.min(axis=0)])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gradients(net: Network, doc: bytes, label: int, weight: float) -> list[np.ndarray]:
    """Gradient of the weighted logistic loss; it reaches only the winning position of each chunk and filter."""
    codes = padded(doc)
    y = net.responses(codes)
    at = y.argmax(axis=1)
    half = np.take_along_axis(y, at[:, None], axis=1)[:, 0]
    at = at + np.arange(len(half))[:, None] * HALF
    pooled = net.pooled(overlapped(half))
    where = np.where(half[:-1] >= half[1:], at[:-1], at[1:]) if len(half) > 1 else at
    cols = np.arange(FILTERS)
    features = combined(pooled)
    g = np.float32(weight * (sigmoid(features @ net.out + net.offset[0]) - label))
    mean, largest, smallest = g * net.out.reshape(3, FILTERS)
    to_pool = np.tile(mean / len(pooled), (len(pooled), 1))
    to_pool[pooled.argmax(axis=0), cols] += largest
    to_pool[pooled.argmin(axis=0), cols] += smallest
    c, f = np.nonzero(pooled > 0)
    spread = np.zeros((len(c), FILTERS), np.float32)
    spread[np.arange(len(c)), f] = to_pool[c, f]
    used = codes[where[c, f][:, None] * STRIDE + np.arange(WIDTH)]
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, used.ravel(), (spread @ net.filters.T).reshape(-1, DIM))
    windows = net.embed[used].reshape(len(c), WIDTH * DIM)
    return [d_embed, windows.T @ spread, spread.sum(axis=0), g * features, np.array([g])]


def fit(docs: list[bytes], labels: list[int], weights: dict[int, float], steps: int = 750, batch: int = 16, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam over shuffled minibatches; as many steps for a small sample as for a large one."""
    net, order = Network.start(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    index: list[int] = []
    for step in range(1, steps + 1):
        while len(index) < batch:
            index += order.permutation(len(docs)).tolist()
        part, index = index[:batch], index[batch:]
        grads = [np.mean(g, axis=0) for g in zip(*(gradients(net, docs[i], labels[i], weights[labels[i]]) for i in part))]
        pace = rate * 0.5 ** (3 * step / steps)
        for p, g, (m, v) in zip(net.params(), grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out_row():
    """Whether a row is never learned from: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000, max_bytes: int = 32768, steps: int = 750) -> Network:
    """Network fitted to at most ``per_class`` labelled documents of each quality, chosen by the hash of their id.

    Bounded sample: the driver learns from at most 2 * ``per_class`` texts of at most ``max_bytes`` bytes, read whole.
    The loss weighs them so that the two qualities count as often as among all labels. Held-out rows are never read. Without
    labels of both kinds the network is untrained.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & ~held_out_row()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    shares = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    chosen = [usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    picked = docs.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    rows = picked.orderBy(F.xxhash64("doc_id"), "quality", "text").limit(2 * per_class).collect()
    found = {q: sum(r["quality"] == q for r in rows) for q in (0, 1)}
    total = sum(shares.values())
    if not all(found.values()):
        return Network.start(7)
    weights = {q: shares[q] / total * len(rows) / found[q] for q in (0, 1)}
    return fit([r["text"].encode("utf-8", "replace") for r in rows], [r["quality"] for r in rows], weights, steps)


def _score(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "text"]
            for part in slices(batch):
                scores = pa.array([net.score(t) for t in texts(part)], pa.float64())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), scores], [*kept, "score"])

    return run


def _keep(net: Network, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array([net.score(t) >= threshold for t in texts(part)], pa.bool_()))

    return run


def score_documents(docs: DataFrame, net: Network, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better quality) and predicted (1 from ``threshold``) of each row of ``docs``.

    The whole text is read as bytes: filters slide over it, each chunk keeps their largest responses,
    chunks overlap by half, and mean, maximum and minimum over all chunks are combined into the score. Nothing but the text
    enters it. Null text is empty and scored as padding alone. Repeated rows get equal scores; an empty
    table gives none.
    """
    rows = docs.select("doc_id", held_out_row().alias("held_out"), "text")
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    return rows.mapInArrow(_score(net), kind).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def filter_documents(docs: DataFrame, net: Network, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; they are judged where they are read."""
    return docs.mapInArrow(_keep(net, threshold), docs.schema)
