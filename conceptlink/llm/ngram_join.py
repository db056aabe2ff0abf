"""Jaccard similarity join of documents on word shingles, by token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import BASE, U64, combine, mix, shingle_sets, slices, texts
from conceptlink.operators.components import connected_components
from conceptlink.operators.staging import written

SKETCH_BITS = 20
_SLICE = 1024
PARITY_BITS = 512
_PAIRS = 1 << 15
_BLOCK = 1024  # documents of one list that are paired in one go


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(k: int):
    """Counts of all shingles by hash bucket, one row per slice of buckets and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in slices(batch):
                counts += np.bincount(_bucket(np.concatenate(shingle_sets(texts(part), k))), minlength=len(counts))
        for i in np.flatnonzero(counts.reshape(-1, _SLICE).any(axis=1)):
            yield pa.RecordBatch.from_pydict({"slice": [int(i)], "counts": [counts[i * _SLICE : (i + 1) * _SLICE].tobytes()]})

    return run


def _add_slices(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
    return pd.DataFrame({"bucket": int(rows["slice"].iloc[0]) * _SLICE + np.arange(_SLICE), "n": total})


def frequent_buckets(docs: DataFrame, k: int) -> np.ndarray:
    """Flags of the buckets that hold frequent shingles, counted over all documents.

    A bucket is frequent above four times the mean, so at most a quarter of the fixed number of buckets is; what
    the driver gets is bounded by the sketch and not by the data. A shingle outside them is in no more documents
    than the bound, since a bucket never counts too little.
    """
    slices = docs.select("text").mapInArrow(_sketch(k), "slice long, counts binary")
    counts = written(slices.groupBy("slice").applyInPandas(_add_slices, "bucket long, n long").filter("n > 0"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    bound = max(64, 4 * total // (1 << SKETCH_BITS))
    flags = np.zeros(1 << SKETCH_BITS, bool)
    flags[[r[0] for r in counts.filter(F.col("n") > bound).select("bucket").collect()]] = True
    return flags


def _least_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _classes(n: int, percent: int) -> int:
    """Number of classes the frequent shingles of a set of n are dealt to: a power of two, growing with n."""
    most = max(1, min(n // 8, _least_overlap(n, percent) - 1))
    return 1 << (most.bit_length() - 1)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Signatures of a set, and how many frequent shingles its plain prefix has. Similar sets share a signature.

    Shingles are ordered rare ones first, then by hash. With n of them and an overlap of at least a, the first
    common one is among the first n - a + 1 of either set. If it is rare, that single shingle is the signature. If
    not, all common ones are frequent, so a set with fewer than a frequent ones needs no more signatures; in
    others, the first n - a + g + 1 hold g + 1 common ones. Dealt to g classes, two fall into one class, and that pair is the signature. g depends on the size alone; a set
    also takes the g of every smaller size it may meet. The lowest bit tells pairs (1) from single shingles (0).
    """
    n = len(tokens)
    least = _least_overlap(n, percent)
    if n == least and 100 * n < percent * (n + 1):
        return np.empty(0, U64), 0  # no smaller and no larger set is similar enough, and equal ones are folded before
    common = frequent[_bucket(tokens)]
    order = np.concatenate([np.sort(mix(tokens[~common])), np.sort(mix(tokens[common]))])
    rare = int((~common).sum())
    first = n - least + 1
    out = [order[: min(first, rare)] & ~U64(1)]
    if least == 1:
        out.append(order[rare:first] & ~U64(1))
    low, high = (_classes(m, percent).bit_length() for m in (least, n))
    for g in (1 << e for e in range(low - 1, high)) if n - rare >= least else ():
        head = order[rare : min(n, first + g)]
        kind = head % U64(g)
        for c in range(g) if len(head) > 1 else ():
            own = head[kind == U64(c)]
            i, j = np.triu_indices(len(own), 1)
            if len(i):
                out.append(combine([np.full(len(i), g, U64), own[i], own[j]]) | U64(1))
    return np.concatenate(out), max(0, first - rare)


def parities(tokens: np.ndarray) -> bytes:
    """For each of a fixed number of hash buckets, whether the set has an odd number of shingles in it.

    Two sets differ in at least as many shingles as in bits, which bounds their overlap from above.
    """
    counts = np.bincount((mix(tokens) % U64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _profile(k: int, percent: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(texts(part), k)
                sigs, common = zip(*(signatures(s, frequent, percent) for s in sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(common, pa.int64()),
                        pa.array(np.array([mix(s).sum() for s in sets], U64).view(np.int64)),
                        pa.array(np.array([mix(s * U64(BASE) + U64(1)).sum() for s in sets], U64).view(np.int64)),
                        pa.array([parities(s) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sigs]))), pa.int32()),
                            pa.array(np.concatenate(sigs).view(np.int64)),
                        ),
                    ],
                    ["doc_id", "n", "f", "h1", "h2", "bits", "sigs"],
                )

    return run


def _token_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [pa.array(s.view(np.int64)) for s in shingle_sets(texts(part), k)]
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(sets))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "tokens"])

    return run


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the signatures that more than one document has.

    Input is ordered by signature and document. Only the current list's head is kept, however long the list.
    """
    names, held = ["sig", "doc_id", "n", "f"], None
    shown = False
    for batch in batches:
        col = [batch.column(c).to_numpy() for c in names]
        if not batch.num_rows:
            continue
        if held is not None:
            col = [np.concatenate(([h], c)) for h, c in zip(held, col)]
        sig = col[0]
        start = np.concatenate(([True], sig[1:] != sig[:-1]))
        head = np.flatnonzero(start)[np.cumsum(start) - 1]
        keep = ~start | np.append(~start[1:], False)
        if held is not None and shown:
            keep[0] = False
        out = np.flatnonzero(keep)
        if len(out):
            yield pa.RecordBatch.from_pydict({k: c[out] for k, c in zip(names, col)})
        last = head[-1]
        shown = (shown and last == 0 and held is not None) or last < len(sig) - 1
        held = [c[last] for c in col]


def needed(n, m, f, g, percent: int, most=max, least=min):
    """Single signatures that two sets of sizes n and m must share to be similar, by what their prefixes leave out.

    An overlap of a = percent * (n + m) / (100 + percent) is needed, and all but the plain prefix of one set can hold at most
    its own least overlap - 1 of it. Of the common ones in both prefixes, only the f and g frequent ones have no
    signature of their own.
    """
    overlap = (percent * (n + m) + 99 + percent) // (100 + percent)
    return overlap - (most((n * percent + 99) // 100, (m * percent + 99) // 100) - 1) - least(f, g)


def _pairs(percent: int):
    """Pairs of documents of one block of a list that lie in different components and whose sizes allow a link."""

    def emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        sig, side, doc, n, f, comp = rows[:6]
        bits = rows[6:].view(U64)
        for s in range(0, len(doc), 256):
            i = np.arange(s, min(s + 256, len(doc)))[:, None]
            j = np.arange(len(doc))[None, :]
            ok = (doc[i] < doc[j]) & (comp[i] != comp[j])
            ok &= (side[i] < 0) | (side[i] != side[j])
            ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            a, b = np.nonzero(ok)
            a = a + s
            need = needed(n[a], n[b], f[a], f[b], percent, np.maximum, np.minimum)
            # a pair that needs a common single shingle is met in that one's list
            use = (sig[a] & 1 == 0) | (need <= 0)
            a, b, need = a[use], b[use], need[use]
            roomy = np.zeros(len(a), bool)
            for t in range(0, len(a), _PAIRS):
                i, j = a[t : t + _PAIRS], b[t : t + _PAIRS]
                differ = np.bitwise_count(bits[:, i] ^ bits[:, j]).sum(axis=0, dtype=np.int64)
                overlap = (percent * (n[i] + n[j]) + 99 + percent) // (100 + percent)
                roomy[t : t + _PAIRS] = n[i] + n[j] - differ >= 2 * overlap
            a, b, need = a[roomy], b[roomy], need[roomy]
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": doc[a], "b": doc[b], "single": 1 - (sig[a] & 1), "need": need})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["i", "j", "sig", "side", "doc_id", "n", "f", "component"]
        words = PARITY_BITS // 64
        rest = np.empty((len(names) + words, 0), np.int64)
        for batch in batches:
            bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.int64).reshape(-1, words)
            rest = np.concatenate([rest, np.stack([*(batch.column(c).to_numpy() for c in names), *bits.T])], axis=1)
            cut = np.flatnonzero((rest[:3, 1:] != rest[:3, :-1]).any(axis=0)) + 1
            for a, b in zip(np.concatenate(([0], cut[:-1])).astype(int), cut):
                yield from emit(rest[2:, a:b])
            if len(cut):
                rest = rest[:, cut[-1] :]
        yield from emit(rest[2:])

    return run


def _links(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links among candidate pairs that share enough single signatures."""
    pairs = written(pairs.groupBy("a", "b").agg(F.sum("single").alias("shared"), F.max("need").alias("need")).filter("shared >= need").select("a", "b"))
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = written(docs.join(wanted, "doc_id", "left_semi").mapInArrow(_token_sets(shingle), "doc_id long, tokens array<long>"))
    x = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    similar = both * 100 >= (F.size("x") + F.size("y") - both) * percent
    return written(pairs.join(x, "a").join(y, "b").filter(similar).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct())


def _open(placed: DataFrame) -> DataFrame:
    """Signatures whose lists touch more than one component, with the lists' sizes."""
    sizes = placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"))
    return sizes.filter("low <> high").select("sig", "size")


def _hubs(placed: DataFrame) -> DataFrame:
    """The most central document of each open list.

    A document is the more central the more rows its open lists have: in a group of copies with edits, the text that the others
    differ least from.
    """
    rows = placed.join(_open(placed), "sig")
    weight = rows.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    best = F.max_by(F.struct("doc_id", "n", "f", "component"), F.struct("weight", -F.col("doc_id"))).alias("h")
    hubs = rows.join(weight, "doc_id").groupBy("sig").agg(best)
    return hubs.select("sig", F.col("h.doc_id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.f").alias("hub_f"), F.col("h.component").alias("hub_component"))


def _to_hubs(placed: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Pairs of each list's hub with its documents of other components, if their sizes allow a link; one row per list."""
    single = 1 - F.col("sig").bitwiseAND(1)
    near = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    need = F.expr(
        f"({percent} * (n + hub_n) + {99 + percent}) div {100 + percent}"
        f" - ((greatest(n, hub_n) * {percent} + 99) div 100 - 1) - least(f, hub_f)"
    )
    pairs = placed.join(hubs, "sig").filter(near & (F.col("hub_component") != F.col("component")) & ((single == 1) | (need <= 0)))
    return pairs.select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b"), single.alias("single"), need.alias("need"))


def similar_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups of ``docs`` (doc_id, text, ...) linked by Jaccard similarity of their word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. A set holds the distinct shingles of ``shingle``
    words, by 64-bit hash; a shorter text is one shingle, a text without words is the empty set and links
    with nothing. Two documents link when 100 * intersection >= ``percent`` * union. Returns one row per input
    row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    Null text is empty. A row without doc_id links with nothing and has a null component. Rows that repeat a
    doc_id are one document whose links are joined. An empty table gives none.

    Equal sets are folded first. The rest meet through ``signatures``. Each list of documents with
    one signature is first compared with its most central one alone, which is linear and joins large groups of
    near copies; what is still in different components is then compared pair by pair, in blocks for long
    lists. Only pairs whose parity bits leave room for the overlap, and with as many common single shingles in their prefixes as ``needed`` are verified. Links inside one component cannot change the result and are not looked for, all others are.
    """
    frequent = frequent_buckets(docs, shingle)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, n long, f long, h1 long, h2 long, bits binary, sigs array<long>"
    profiles = written(known.mapInArrow(_profile(shingle, percent, frequent), kind))
    present = profiles.filter("doc_id is not null and n > 0")
    folded = written(present.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("first")))
    same = present.select("doc_id", "n", "h1", "h2").join(folded, ["n", "h1", "h2"]).select(F.col("doc_id").alias("src"), F.col("first").alias("dst"))
    heads = present.filter(F.size("sigs") > 0).join(folded.withColumnRenamed("first", "doc_id"), ["n", "h1", "h2", "doc_id"], "left_semi")
    rows = heads.select(F.explode("sigs").alias("sig"), "doc_id", "n", "f").repartition("sig").sortWithinPartitions("sig", "doc_id", "n", "f")
    lists = written(rows.mapInArrow(_shared_lists, "sig long, doc_id long, n long, f long"))

    unplaced = lists.withColumn("component", F.col("doc_id"))
    links = _links(_to_hubs(unplaced, _hubs(unplaced), percent), known, shingle, percent)
    linked = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    groups = written(connected_components(linked, links)).withColumnRenamed("id", "doc_id")
    placed = written(lists.join(groups, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
    open_lists = _open(placed)
    blocks = F.ceil(F.col("size") / _BLOCK).cast("long")
    dealt = (
        placed.join(open_lists, "sig")
        .join(heads.select("doc_id", "n", "bits").distinct(), ["doc_id", "n"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "n", "f", "component", "bits")
        # in block (i, i) all rows meet, in block (i, j) only those of different halves
        .withColumn("side", F.when(F.col("i") == F.col("j"), F.lit(-1).cast("long")).otherwise(F.col("own")))
    )
    cross = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(_pairs(percent), "a long, b long, single long, need long")
    more = _links(cross, known, shingle, percent)

    vertices = present.select(F.col("doc_id").alias("id")).distinct()
    final = connected_components(vertices, same.unionByName(links).unionByName(more))
    out = profiles.select("doc_id", F.col("n").alias("n_shingles")).join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
