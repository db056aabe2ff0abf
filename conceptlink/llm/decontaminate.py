"""Benchmark passages in documents: spaced seeds of both sides are joined, overlaps are checked with substitutions allowed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.llm.common import U64, combine, slices, texts, Words
from conceptlink.operators.staging import written

# Seed masks, 1 = the word counts, 0 = it may be anything. The first set leaves no window of 16 words with up
# to 3 substitutions unhit, the second no window of 5 to 15 words with up to a fifth substituted.
LONG_MASKS = ("1111011", "11000010111", "10100001111")
SHORT_MASKS = ("111", "1101")
WINDOW = 16
SUBSTITUTED = 5  # items of fewer words are found whole only
_PART = 256  # words of an item or of a spot of a document in one row
_HOT = 20_000  # occurrences of a seed in the documents that one task joins


def _masks(n: int) -> tuple[str, ...]:
    if n < SUBSTITUTED:
        return ("1" * n,)
    return LONG_MASKS if n >= WINDOW else SHORT_MASKS


def _seeds(words: np.ndarray, mask: str, whole: bool = False) -> np.ndarray:
    """Hash of the words under the mask at each position; those of whole items differ from all others."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, U64)
    return combine([np.full(n, 2 * int(mask, 2) + whole, U64), *(words[i : i + n] for i, c in enumerate(mask) if c == "1")])


def _item_words(least: int):
    """Word hashes of each item of ``least`` words or more, long ones in parts that overlap by a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = Words(texts(part))
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    own = w.hash[w.bounds[i] : w.bounds[i + 1]].view(np.int64)
                    rows = [own[a : a + _PART] for a in range(0, max(1, len(own) - WINDOW + 1), _PART - WINDOW + 1)] if len(own) >= max(least, 1) else []
                    if rows:
                        cols = [pa.array([item] * len(rows), pa.int64()), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(cols, ["item_id", "words"])

    return run


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of each part of an item with their places in it."""
    for batch in batches:
        for key, words in zip(batch.column("key").to_pylist(), batch.column("words").to_pylist()):
            w = np.array(words, np.int64).view(U64)
            for mask in _masks(len(w)):
                h = _seeds(w, mask, len(w) < SUBSTITUTED)
                cols = [pa.array(h.view(np.int64)), pa.array([key] * len(h), pa.int64()), pa.array(np.arange(len(h), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["seed", "key", "at"])


class SeedFilter:
    """Two bits for each benchmark seed in a table of 2**``bits`` bits; says which seeds surely are none of the benchmark's."""

    LOW, HIGH = 16, 27  # 8 KB to 16 MB

    def __init__(self, seeds: DataFrame, n: int):
        self.bits = min(max((256 * n).bit_length(), self.LOW), self.HIGH)
        probes = F.array(F.shiftrightunsigned("seed", 64 - self.bits), F.col("seed").bitwiseAND((1 << self.bits) - 1))
        slot: Column = F.col("slot") + 1  # the bitmap functions count from 1
        words = seeds.select(F.explode(probes).alias("slot")).groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        self.table = np.zeros(max(1, (1 << self.bits) >> 3), np.uint8)
        for r in words.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bytes")).toLocalIterator():
            own = np.frombuffer(r["bytes"], np.uint8)
            at = (r["bucket"] - 1) * len(own)
            self.table[at : at + len(own)] = own

    def _has(self, slot: np.ndarray) -> np.ndarray:
        return (self.table[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & 1 > 0

    def places(self, h: np.ndarray) -> np.ndarray:
        """Positions in ``h`` of the seeds that may be the benchmark's."""
        at = np.flatnonzero(self._has(h >> U64(64 - self.bits)))
        return at[self._has(h[at] & U64((1 << self.bits) - 1))]


def _spots(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hits, by number, whose surroundings overlap and together stay within the words of one row."""
    out, first, end = [], 0, -1
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        if i and (a >= end or b - int(low[first]) > _PART):
            out.append((first, i))
            first = i
        end = b
    return [*out, (first, len(low))] if len(low) else out


_SPOT = "doc_id long, start int, words array<long>, seeds array<long>, at array<int>"


def _scan(filter_: SeedFilter, sizes: frozenset[int]):
    """Spots of the documents around seeds that may be the benchmark's, each with all words that a window over a hit may hold.

    Of whole short items a document's first place is enough; these rows hold no words.
    """
    masks = [m for least, m in ((WINDOW, LONG_MASKS), (SUBSTITUTED, SHORT_MASKS)) if least in sizes]
    whole = sorted(n for n in sizes if n < SUBSTITUTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = filter_.value
        for batch in (part for b in batches for part in slices(b)):
            ids, w = batch.column("doc_id").to_pylist(), Words(texts(batch))
            rows = []
            owner = np.repeat(np.arange(len(ids)), np.diff(w.bounds))
            first, last = (w.bounds[:-1][owner], w.bounds[1:][owner])  # of each word's document
            hits = [np.empty((0, 4), np.int64)]
            for mask in (m for group in masks for m in group):
                h = _seeds(w.hash, mask)
                at = seeds.places(h)
                at = at[at + len(mask) <= last[at]]
                low, high = np.maximum(first[at], at + len(mask) - WINDOW), np.minimum(last[at], at + WINDOW)
                hits.append(np.stack([at, low, high, h[at].view(np.int64)], axis=1))
            found = np.concatenate(hits)
            found = found[np.lexsort((found[:, 2], found[:, 1]))]
            for a, b in _spots(found[:, 1], found[:, 2]):
                x, y = int(found[a, 1]), int(found[a:b, 2].max())
                d = int(owner[x])
                rows.append((ids[d], x - int(w.bounds[d]), w.hash[x:y].view(np.int64), found[a:b, 3], found[a:b, 0] - x))
            for n in whole:
                h = _seeds(w.hash, "1" * n, True)
                at = seeds.places(h)
                at = at[at + n <= last[at]]
                # the smallest place of each seed in each document
                at = at[np.unique(np.stack([owner[at].astype(U64), h[at]]), axis=1, return_index=True)[1]] if len(at) else at
                for p in at.tolist():
                    rows.append((ids[int(owner[p])], p - int(first[p]), np.empty(0, np.int64), h[p : p + 1].view(np.int64), np.zeros(1, np.int64)))
            if rows:
                doc, start, words, seed, places = zip(*rows)
                cols = [pa.array(doc, pa.int64()), pa.array(start, pa.int32())]
                cols += [pa.array(list(words), pa.list_(pa.int64())), pa.array(list(seed), pa.list_(pa.int64())), pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "words", "seeds", "at"])

    return run


def _verify(percent: int):
    """The best window of each aligned spot and item part: most equal words, then the first place; whole items as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("doc_id", "start", "words", "item_id", "item_words", "shift")
            rows = []
            for doc, start, words, item_id, item, shift in zip(*(batch.column(n).to_pylist() for n in names)):
                if len(item) < SUBSTITUTED:
                    rows.append((doc, item_id, len(item), start))
                    continue
                window = min(len(item), WINDOW)
                a, b = max(shift, 0), min(shift + len(item), len(words))
                if b - a >= window:
                    same = np.array(words[a:b]) == np.array(item[a - shift : b - shift])
                    total = np.concatenate(([0], np.cumsum(same)))
                    equal = total[window:] - total[:-window]
                    if 100 * equal.max() >= percent * window:
                        rows.append((doc, item_id, int(equal.max()), start + a + int(equal.argmax())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "item_id", "n_equal", "first_word"])

    return run


def _aligned(hits: DataFrame, seeds: DataFrame) -> DataFrame:
    """Distinct (spot, key, shift) of the join on the seed; seeds that many documents hold are dealt to several tasks."""
    hot = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > _HOT)
    hot = written(hot.select("seed", F.ceil(F.col("n") / _HOT).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    mine = hits.join(hot, "seed", "left").withColumn("salt", F.pmod(F.xxhash64("spot", "at"), parts).cast("int")).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), parts - 1))
    theirs = seeds.join(hot, "seed", "left").select("seed", "key", F.col("at").alias("item_at"), copies.alias("salt"))
    return mine.join(theirs, ["seed", "salt"]).select("spot", "key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80, least: int = 1) -> DataFrame:
    """Documents of ``docs`` (doc_id, text, ...) that hold a passage of ``benchmark`` (item_id, text, ...).

    A document holds an item if some 16 consecutive words of the item (all words of one of 5 to 15) stand in
    it aligned, with at least ``percent`` of them equal (80 or more) and the rest substituted. Items of 1 to 4 words must
    stand in it whole and equal. Items of fewer than ``least`` words are passed over, and those without words. Words are
    runs without ASCII white space, A-Z lower-cased. Returns one row per document and item: doc_id, item_id, n_equal
    (equal words of the best window of at most 16) and first_word (that window's place in the document, the first on a tie).

    Null texts are empty and hold nothing; null ids come back as null, all null ids as one; repeated rows and items give one
    row. An empty table on either side gives none. Very long texts leave as spots of at most 256 words. Further
    columns are ignored.

    Both sides are hashed under fixed masks that skip positions. A filter of at most 16 MB, made of the benchmark's seeds in Spark,
    tells the scan of the documents which seeds cannot match; the others travel with the words around them, are
    joined with the benchmark's seeds and compared word by word along the alignment. A larger benchmark makes the
    filter let more seeds through, and the join drops them. The driver holds the filter alone.
    """
    if percent < 80:
        raise ValueError("the masks find windows with at least 80 percent of the words equal")
    spark = docs.sparkSession
    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    parts = source.mapInArrow(_item_words(least), "item_id long, words array<long>").distinct()
    items = written(parts.withColumn("key", F.monotonically_increasing_id()))
    seeds = written(items.select("key", "words").mapInArrow(_item_seeds, "seed long, key long, at int"))
    # which masks the documents need: those of 16, of 5 to 15, and of each smaller number of words
    n_words = F.size("words")
    kind = F.when(n_words >= WINDOW, WINDOW).when(n_words >= SUBSTITUTED, SUBSTITUTED).otherwise(n_words)
    sizes = frozenset(r["kind"] for r in items.select(kind.alias("kind")).distinct().collect())
    known = spark.sparkContext.broadcast(SeedFilter(seeds, seeds.count()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spots = written(rows.mapInArrow(_scan(known, sizes), _SPOT).withColumn("spot", F.monotonically_increasing_id()))
    known.unpersist()
    hits = spots.select("spot", F.explode(F.arrays_zip("seeds", "at")).alias("h")).select("spot", F.col("h.seeds").alias("seed"), "h.at")
    item = items.select("key", "item_id", F.col("words").alias("item_words"))
    pairs = _aligned(hits, seeds).join(spots.select("spot", "doc_id", "start", "words"), "spot").join(item, "key")
    found = pairs.mapInArrow(_verify(percent), "doc_id long, item_id long, n_equal long, first_word long")
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("first")))
    out = found.groupBy("doc_id", "item_id").agg(best.alias("best"))
    return out.select("doc_id", "item_id", "best.n_equal", (-F.col("best.first")).alias("first_word"))
