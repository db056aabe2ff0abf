"""Word windows that an earlier document holds, found by FM-indexes over shards of anchored segments."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import SPACE, U64, combine, mix, powers, run_hashes, slices, texts
from conceptlink.llm.fm_index import FMIndex
from conceptlink.llm.suffix_dedup import _INVERSE, BASE, _window_least
from conceptlink.operators.staging import written

_BYTES = 1 << 20  # text hashed at once
_PIECE = 1 << 18  # words cut into segments at once; pieces overlap, so the bound drops nothing
_FOLD = 1 << 18  # segments of a task that are compared with each other before they are sent
_SHARD = 1 << 17  # words of one index
_GROUP = 4096  # segments of one anchor in one index


def word_hashes(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of some documents, in order, and the number of each one's words."""
    whole = b"\n".join(docs) + b"\n"
    ends = np.cumsum([len(d) + 1 for d in docs])
    hashes, starts, at = [], [], 0
    while at < len(whole):
        stop = min(at + _BYTES, len(whole))
        # cut where a word ends
        while not SPACE[whole[stop - 1]]:
            stop += 1
        buf = np.frombuffer(whole, np.uint8, stop - at, at)
        gap = np.concatenate(([True], SPACE[buf]))
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        hashes.append(run_hashes(buf, edge[0::2], edge[1::2]))
        starts.append(edge[0::2] + at)
        at = stop
    first = np.concatenate(starts)
    return np.concatenate(hashes), np.diff(np.searchsorted(first, ends), prepend=0)


def segments(words: np.ndarray, doc: np.ndarray, span: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of ``span`` words within one document, grouped by their anchor: the window's least ``gram`` words (the leftmost of equals).

    Yields anchor hash, content hash, first window and number of windows. Equal windows have equal anchors at equal distances,
    whatever stands around them.
    """
    bits = U64(_PIECE.bit_length() + 1)
    for begin in range(0, len(words) - span + 1, _PIECE):
        w = words[begin : begin + _PIECE + span - 1]
        n = len(w) - span + 1
        inside = np.flatnonzero(doc[begin : begin + n] == doc[begin + span - 1 : begin + span - 1 + n])
        if not len(inside):
            continue
        grams = combine([w[i : len(w) - gram + 1 + i] for i in range(gram)])
        key = (grams >> bits << bits) | np.arange(len(grams), dtype=U64)
        anchor = (_window_least(key, span - gram + 1)[inside] & ((U64(1) << bits) - U64(1))).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1))))
        low, count = inside[new], np.diff(np.append(new, len(inside)))
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(w * powers(len(w)), dtype=U64)))
        content = (sums[low + count + span - 1] - sums[low]) * powers(len(w), _INVERSE)[low]
        yield grams[anchor[new]], mix(content + (anchor[new] - low).astype(U64) * U64(BASE)), begin + low, count


_SEGMENT = "g long, c long, doc long, row long, low int, n int, copy boolean"
_NAMES = [f.split()[0] for f in _SEGMENT.split(", ")]


def _segment_rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds)], _NAMES)


def _folded(g, c, doc, row, low, n) -> pa.RecordBatch:
    """Segments of a task's share of the documents; those whose content a smaller document of the share holds are settled (copies).

    Copies leave the group of their anchor, so a passage of many documents sends that group one row from each share.
    """
    order = np.lexsort((doc, c, g))
    g, c, doc, row, low, n = (x[order] for x in (g, c, doc, row, low, n))
    first = np.concatenate(([True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
    copy = doc > doc[np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))]
    g = np.where(copy, mix((doc * 31 + low).view(U64)).view(np.int64), g)
    return _segment_rows([g, c, doc, row, low, n, copy])


def _find_segments(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for part in slices(batch):
                words, counts = word_hashes(texts(part))
                ids, marks = (part.column(c).to_numpy() for c in ("doc_id", "row"))
                owner = np.repeat(np.arange(len(counts)), counts)
                begin = np.concatenate(([0], np.cumsum(counts)))
                for g, c, low, n in segments(words, owner, span, gram):
                    at = owner[low]
                    found.append((g.view(np.int64), c.view(np.int64), ids[at], marks[at], low - begin[at], n))
                    size += len(low)
                if size > _FOLD:
                    yield _folded(*map(np.concatenate, zip(*found)))
                    found, size = [], 0
        if size:
            yield _folded(*map(np.concatenate, zip(*found)))

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments ordered by (anchor, copy, content, document): copies, and the first document's segments of contested anchors.

    An anchor is contested if it has more than one content; only then can a window of one content lie in another. Of an open anchor
    only the rows of its first content are kept between batches as long as there is no second one: those of one document.
    """
    held: list[list[np.ndarray]] = []  # first-document rows of an open anchor's only content so far
    g0 = c0 = doc0 = None
    contested = False
    for batch in batches:
        if not batch.num_rows:
            continue
        col = [batch.column(n).to_numpy(zero_copy_only=False) for n in _NAMES]
        g, c, doc, marked = col[0], col[1], col[2], col[6].astype(bool)
        new_g = np.concatenate(([g0 is None or g[0] != g0], g[1:] != g[:-1]))
        new_c = new_g | np.concatenate(([c0 is None or c[0] != c0], c[1:] != c[:-1]))
        start = np.maximum.accumulate(np.where(new_c, np.arange(len(g)), -1))
        first_doc = np.where(start < 0, doc0 if doc0 is not None else 0, doc[np.maximum(start, 0)])
        copy = marked | (doc > first_doc)
        group = np.cumsum(new_g)  # 0: the anchor that was open before this batch
        contents = np.bincount(group, weights=new_c & ~marked, minlength=group[-1] + 1).astype(int)
        many = contents > 1
        if not new_g[0] and not contested and contents[0]:
            many[0] = True
        many[0] |= contested
        if held and many[0]:
            for rows in held:
                yield _segment_rows(rows)
            held = []
        out = copy | many[group]
        if out.any():
            yield _segment_rows([x[out] for x in [*col[:6], copy]])
        last = group[-1]
        if last:
            held = []
        stay = (group == last) & ~copy
        contested = bool(many[last])
        if not contested and stay.any():
            held.append([x[stay] for x in [*col[:6], copy]])
        g0, c0, doc0 = g[-1], c[-1], first_doc[-1]


def _cut_segments(span: int):
    """Word hashes of the contested segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_BYTES // 4):
                words, counts = word_hashes(texts(part))
                begin = np.concatenate(([0], np.cumsum(counts)))
                rows = []
                for i, (doc, mark, found) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "row", "parts")))):
                    for p in found:
                        at = begin[i] + p["low"]
                        rows.append((p["g"], doc, mark, p["low"], words[at : at + p["n"] + span - 1].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(("g", "doc", "row", "low", "words"), map(list, zip(*rows)))))

    return run


_RANGE = "doc long, row long, low long, n long"


def held_earlier(docs: np.ndarray, streams: list[np.ndarray], span: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each stream of word hashes, the runs of windows that a stream of a smaller document holds too: first windows and lengths.

    The streams are one shard: all are indexed, and then all are matched against the index.
    """
    sizes = np.array([len(s) for s in streams])
    starts = np.cumsum(sizes) - sizes
    symbols = np.unique(np.concatenate(streams), return_inverse=True)[1] + 1
    owner = np.repeat(np.arange(len(streams)), sizes)
    place = np.arange(len(symbols)) + owner  # one separator after each stream
    text = np.zeros(len(symbols) + len(streams), np.int64)
    text[place] = symbols
    holder = np.full(len(text), docs.max(initial=0), np.int64)
    holder[place] = docs[owner]
    index = FMIndex(text, span)
    length, low, high = index.matching_statistics(symbols, starts, sizes)
    hit = np.flatnonzero(length >= span)
    hit = hit[index.least(holder, low[hit], high[hit]) < docs[owner[hit]]]
    first = np.flatnonzero(np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])))) if len(hit) else hit
    count = np.diff(np.append(first, len(hit)))
    at = hit[first]
    bound = np.searchsorted(owner[at], np.arange(len(streams) + 1))
    return [(at[a:b] - starts[i], count[a:b]) for i, (a, b) in enumerate(zip(bound[:-1], bound[1:]))]


def _search_shards(span: int):
    """Index each shard, a run of anchors with about ``_SHARD`` words, and search its segments in it."""

    def search(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, doc, mark, low, raw = zip(*rows)
        found = held_earlier(np.array(doc), [np.frombuffer(r, U64) for r in raw], span)
        out = [(doc[i], mark[i], low[i] + int(a), int(n)) for i, (at, count) in enumerate(found) for a, n in zip(at, count)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc", "row", "low", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for row in zip(*(part.column(c).to_pylist() for c in ("g", "doc", "row", "low", "words"))):
                    if size > _SHARD and row[0] != rows[-1][0]:
                        yield from search(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += len(row[4]) // 8
        if rows:
            yield from search(rows)

    return run


def _remove(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc, found in zip(texts(part), part.column("ranges").to_pylist()):
                    words = doc.split()  # bytes: blanks are 0x20 and 0x09 to 0x0D
                    n, at, kept = len(words), 0, []
                    for a, b in sorted((r["low"], r["low"] + r["n"] + span - 1) for r in found or ()):
                        kept += words[at:a]
                        at = max(at, b)
                    kept += words[at:]
                    whole = b" ".join(kept)
                    out.append((n, n - len(kept), hashlib.sha256(whole).hexdigest(), whole))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
                cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def dedup_windows(docs: DataFrame, span: int = 13, gram: int = 4, group: int = _GROUP) -> DataFrame:
    """Remove every word of ``docs`` (doc_id, text, ...) covered by ``span`` consecutive words that a document with a smaller doc_id holds too.

    Words are runs of other characters than 0x20 and 0x09 to 0x0D, unchanged. Windows are judged on the input. Returns
    per row doc_id, n_words, n_removed, kept_sha256 and kept (bytes: the words left, joined by one space).

    Null text has no words; texts of fewer than ``span`` words stay whole. Rows that repeat a doc_id are texts of one document,
    which is not smaller than itself: equal rows get equal results. Rows without doc_id keep all words and remove none from others.
    A very long text is one row, cut into segments piece by piece. Other columns are not read. An empty table gives none.

    Searching every document in every index would cost their product. Here a segment is the windows with one anchor, and
    segments are dealt to shards by their anchor, so a window has to be searched in one index only. Segments that
    equal one of a smaller document in two 64-bit hashes go whole. Anchors with several contents are indexed, each shard by itself: an FM-index
    over the segments of the first document of each content, against which these stream for their matching statistics. Windows
    matched over the whole span report the smallest document among the occurrences. An anchor with more than ``group`` contents
    (the edge of a passage of very many documents) would fill a shard: its windows meet by their words instead, aggregated before the shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    # only where ids repeat does a text need a name of its own
    rows = rows.withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))) if repeated else F.lit(0).cast("long"))
    found = rows.filter("doc_id is not null").mapInArrow(_find_segments(span, gram), _SEGMENT)
    dealt = found.repartition("g").sortWithinPartitions("g", "copy", "c", "doc")
    settled = written(dealt.mapInArrow(_settle, _SEGMENT))
    copies = settled.filter("copy").selectExpr("doc", "row", "cast(low as long) low", "cast(n as long) n")

    contested = settled.filter("not copy")
    wanted = contested.groupBy("doc", "row").agg(F.collect_list(F.struct("g", "low", "n")).alias("parts"))
    cut = rows.join(wanted.withColumnRenamed("doc", "doc_id"), ["doc_id", "row"]).select("doc_id", "row", "text", "parts")
    cut = cut.mapInArrow(_cut_segments(span), "g long, doc long, row long, low long, words binary")
    large = written(contested.groupBy("g").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > group).select("g"))
    if large.limit(1).count():
        cut = written(cut)
        crowded = cut.join(large, "g", "left_semi")
        cut = cut.join(large, "g", "left_anti")
    shards = cut.repartition("g").sortWithinPartitions("g")
    ranges = copies.unionByName(written(shards.mapInArrow(_search_shards(span), _RANGE)))
    if large.limit(1).count():
        at = F.explode(F.sequence(F.lit(0), (F.octet_length("words") / 8).cast("int") - span))
        single = crowded.select("doc", "row", "low", "words", at.alias("i"))
        window = F.substring(F.col("words"), F.col("i") * 8 + 1, F.lit(8 * span))
        single = written(single.select("doc", "row", (F.col("low") + F.col("i")).alias("low"), window.alias("window")))
        least = single.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most")
        later = single.join(least, "window").filter("doc > least")
        ranges = ranges.unionByName(later.select("doc", "row", "low", F.lit(1).cast("long").alias("n")))
    per_doc = ranges.groupBy(F.col("doc").alias("doc_id"), "row").agg(F.collect_list(F.struct("low", "n")).alias("ranges"))
    joined = rows.join(per_doc, ["doc_id", "row"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_remove(span), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
