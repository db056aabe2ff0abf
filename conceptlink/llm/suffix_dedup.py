"""Repeated byte strings found by sorting sampled suffixes whose order is decided by prefix hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import BASE, BYTE, U64, mix, powers, slices, texts
from conceptlink.operators.ranking import global_index
from conceptlink.operators.staging import written

_INVERSE = pow(BASE, -1, 1 << 64)
_PIECE = 1 << 20  # bytes hashed at once; pieces of one document overlap, so the bound drops nothing
_GROUP = 2048  # segments of one anchor that are sorted together


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string: the hash of any substring is one subtraction away."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.buf = buf
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE[buf] * powers(n), out=self.sums[1:])
        self.back = powers(n + 1, _INVERSE)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def common(self, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
        """Length of the common extension of the suffixes x and y, up to ``limit``, by binary search."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), limit, np.int64)
        for _ in range(limit.bit_length()):
            mid = (low + high + 1) >> 1
            same = self.of(x, mid) == self.of(y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
        """Whether suffix x sorts before suffix y by their first ``limit`` bytes; equal ones go by place."""
        n = self.common(x, y, limit)
        end = n == limit
        at = np.where(end, 0, n)
        return np.where(end, x < y, self.buf[x + at] < self.buf[y + at])


def merge_sort(h: PrefixHashes, suffixes: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Sort suffixes within their groups (equal numbers, side by side); all merges of one width run at once."""
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, len(group)))
    base, total = np.repeat(first, size), np.repeat(size, size)
    out = suffixes.copy()
    width = 1
    while width < size.max(initial=1):
        at = np.flatnonzero(total > width)
        local = at - base[at]
        block = local // width
        left = block % 2 == 0
        other = np.where(left, block + 1, block - 1) * width
        stop = np.minimum(other + width, total[at])
        low, high = np.minimum(other, stop), stop.copy()
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            mid = (low[todo] + high[todo]) >> 1
            goes = h.before(out[base[at[todo]] + mid], out[at[todo]], limit)
            low[todo] = np.where(goes, mid + 1, low[todo])
            high[todo] = np.where(goes, high[todo], mid)
        passed = low - np.minimum(other, stop)
        place = base[at] + np.where(left, block, block - 1) * width + (local - block * width) + passed
        new = out.copy()
        new[place] = out[at]
        out = new
        width *= 2
    return out


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if width > step else values


def _segments(doc: np.ndarray, span: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of ``span`` bytes grouped by their anchor, the window's least gram (leftmost of equal ones).

    Yields anchor hash, content hash, first and last window start and anchor start of each segment. Equal windows have
    equal anchors at equal distances, whatever stands around them.
    """
    bits = U64(_PIECE.bit_length())
    for begin in range(0, len(doc) - span + 1, _PIECE - span + 1):
        buf = doc[begin : begin + _PIECE]
        h = PrefixHashes(buf)
        grams = mix(h.of(np.arange(len(buf) - gram + 1), gram))
        key = (grams >> bits << bits) | np.arange(len(grams), dtype=U64)
        anchor = (_window_least(key, span - gram + 1) & ((U64(1) << bits) - U64(1))).astype(np.int64)
        low = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        high = np.append(low[1:], len(anchor)) - 1
        a = anchor[low]
        yield grams[a], mix(h.of(low, high + span - low) + (a - low).astype(U64)), begin + low, begin + high, begin + a


def _find_segments(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in (part for whole in batches for part in slices(whole)):
            for k, d in zip(batch.column("key").to_numpy(), texts(batch)):
                for g, c, low, high, at in _segments(np.frombuffer(d, np.uint8), span, gram):
                    rows.append((g.view(np.int64), c.view(np.int64), np.full(len(low), k), low, high, at))
                    size += len(low)
                if size > 1 << 16:
                    yield _folded(*map(np.concatenate, zip(*rows)))
                    rows, size = [], 0
        if rows:
            yield _folded(*map(np.concatenate, zip(*rows)))

    return run


def _folded(g, c, doc, low, high, at) -> pa.RecordBatch:
    """Segments of a batch; all but the first of equal ones are marked as copies and leave their anchor's group."""
    order = np.lexsort((low, doc, c, g))
    g, c, doc, low, high, at = (x[order] for x in (g, c, doc, low, high, at))
    copy = np.concatenate(([False], (g[1:] == g[:-1]) & (c[1:] == c[:-1])))
    g = np.where(copy, mix((doc * 31 + low).view(U64)).view(np.int64), g)
    return pa.RecordBatch.from_pydict({"g": g, "c": c, "doc": doc, "low": low, "high": high.astype(np.int32) - low.astype(np.int32), "at": at.astype(np.int32) - low.astype(np.int32), "copy": copy})


_SEGMENT = "g long, c long, doc long, low long, high int, at int, copy boolean"


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments ordered by (anchor, copy, content, document, start): copies, and first ones of contested anchors.

    Keeps one row between batches, so the length of a group does not matter.
    """
    names = ["g", "c", "doc", "low", "high", "at", "copy"]
    held = None  # last first-of-its-content row not yet given out, alone in its group so far
    g0 = c0 = None
    for batch in batches:
        col = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if not len(col[0]):
            continue
        g, c, marked = col[0], col[1], col[6].astype(bool)
        new_g = np.concatenate(([g0 is None or g[0] != g0], g[1:] != g[:-1]))
        new_c = new_g | np.concatenate(([c0 is None or c[0] != c0], c[1:] != c[:-1]))
        copy = marked | ~new_c
        first = np.flatnonzero(~copy)
        # firsts of one group stand side by side in this index
        run = np.cumsum(new_g)[first]
        alone = np.ones(len(first), bool)
        same = run[1:] == run[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        carried = run == 0  # of the group that began in an earlier batch
        alone &= ~carried
        emit_held = held is not None and carried.any()
        out = [x[np.sort(np.concatenate((np.flatnonzero(copy), first[~alone])))] for x in col]
        flag = copy[np.sort(np.concatenate((np.flatnonzero(copy), first[~alone])))]
        if emit_held:
            out = [np.concatenate(([h], x)) for h, x in zip(held, out)]
            flag = np.concatenate(([False], flag))
            held = None
        last_group = np.cumsum(new_g)[-1]
        if last_group:  # a new group is open at the end of this batch
            open_first = first[run == last_group]
            held = tuple(x[open_first[0]] for x in col) if len(open_first) == 1 else None
        g0, c0 = g[-1], c[-1]
        if len(flag):
            out[6] = flag
            yield pa.RecordBatch.from_pydict(dict(zip(names, out)))


def _cut_segments(span: int):
    """Bytes of the contested segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for key, doc, parts in zip(batch.column("key").to_pylist(), texts(batch), batch.column("parts").to_pylist()):
                rows += [(p["g"], key, p["low"], p["high"], p["at"], doc[p["low"] : p["low"] + p["high"] + span]) for p in parts]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("g", "doc", "low", "high", "at", "bytes"), map(list, zip(*rows)))))

    return run


def _sort_segments(span: int):
    """Sort the windows of each anchor's segments; of equal ones all but the first are repeats.

    A group above the bound is sorted in parts. The first of each distinct window of such a part goes on with its bytes
    (``open``), to be compared with the other parts.
    """

    def sort(g, doc, low, high, at, raw) -> pa.RecordBatch:
        length = high + span
        base = np.concatenate(([0], np.cumsum(length)[:-1]))
        h = PrefixHashes(np.frombuffer(b"".join(raw), np.uint8))
        n = high + 1
        seg = np.repeat(np.arange(len(n)), n)
        step = np.arange(int(n.sum())) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
        far = at[seg] - step  # distance to the anchor
        order = np.lexsort((low[seg] + step, doc[seg], far, g[seg]))
        seg, step, far = seg[order], step[order], far[order]
        group = np.cumsum(np.concatenate(([True], (g[seg][1:] != g[seg][:-1]) | (far[1:] != far[:-1]))))
        # number the windows in document order, so that ties in the sort keep it
        shift = base[seg] + step
        rank = _Ranked(h, shift)
        ordered = merge_sort(rank, np.arange(len(shift)), group, span)
        x, y = ordered[:-1], ordered[1:]
        equal = (group[x] == group[y]) & (rank.common(x, y, span) == span)
        for i in np.flatnonzero(equal):  # equal hashes are not yet equal bytes
            a, b = int(shift[x[i]]), int(shift[y[i]])
            equal[i] = h.buf[a : a + span].tobytes() == h.buf[b : b + span].tobytes()
        repeat = np.zeros(len(shift), bool)
        repeat[y[equal]] = True
        return doc[seg], low[seg] + step, repeat, g[seg], shift, h

    def give(rows: list, counts: dict) -> Iterator[pa.RecordBatch]:
        g, doc, low, high, at, raw, whole = (list(c) for c in zip(*rows))
        doc, start, repeat, g, shift, h = sort(np.array(g), np.array(doc), np.array(low), np.array(high), np.array(at), raw)
        split = np.isin(g, [k for k, v in counts.items() if v])
        out = np.flatnonzero(repeat | split)
        if len(out):
            opened = split[out] & ~repeat[out]
            window = [h.buf[a : a + span].tobytes() if o else None for a, o in zip(shift[out].tolist(), opened)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(start[out]), pa.array(window, pa.binary())], ["doc", "start", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, used, split = [], 0, {}
        for batch in (part for whole in batches for part in slices(whole, "bytes")):
            for row in zip(*(batch.column(c).to_pylist() for c in ("g", "doc", "low", "high", "at", "bytes", "part"))):
                new = not rows or row[0] != rows[-1][0] or row[6] != rows[-1][6]
                if new and used > 1 << 19:
                    yield from give(rows, split)
                    rows, used, split = [], 0, {}
                split[row[0]] = row[6] is not None
                rows.append(row)
                used += len(row[5])
        if rows:
            yield from give(rows, split)

    return run


class _Ranked(PrefixHashes):
    """Suffixes addressed by their rank in document order instead of their place in the buffer."""

    def __init__(self, h: PrefixHashes, places: np.ndarray):
        self.inner, self.places = h, places

    def common(self, x, y, limit):
        return self.inner.common(self.places[x], self.places[y], limit)

    def before(self, x, y, limit):
        px, py = self.places[x], self.places[y]
        n = self.inner.common(px, py, limit)
        end = n == limit
        at = np.where(end, 0, n)
        return np.where(end, x < y, self.inner.buf[px + at] < self.inner.buf[py + at])


def _remove(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            docs, out = texts(batch), []
            for doc, found in zip(docs, batch.column("ranges").to_pylist()):
                kept, end, n = [], 0, 0
                runs = sorted((r["low"], r["high"] + span) for r in found or ())
                spans = []
                for a, b in runs:
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                for a, b in spans:
                    kept.append(doc[end:a])
                    n += b - a
                    end = b
                kept = b"".join([*kept, doc[end:]])
                out.append((len(doc), n, len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``key``, a number in the order of documents that no two different documents share.

    That is doc_id itself if it is unique. Else documents are numbered by doc_id (null first) and text hash.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.filter("n > 1 or doc_id is null").limit(1).count():
        return rows.withColumn("key", F.col("doc_id"))
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    names = rows.select("doc_id", mark.alias("mark")).distinct().withColumn("lead", F.coalesce("doc_id", F.lit(-(1 << 63))))
    numbered = written(global_index(names, ["lead", "mark"], "key"))
    joined = rows.withColumn("mark", mark).alias("r").join(numbered.alias("n"), F.expr("r.doc_id <=> n.doc_id and r.mark = n.mark"))
    return joined.select("r.doc_id", "r.text", "n.key")


def dedup_substrings(docs: DataFrame, span: int = 100, gram: int = 32) -> DataFrame:
    """Remove every byte of ``docs`` (doc_id, text, ...) covered by a ``span``-byte string that also starts earlier.

    Earlier means a smaller doc_id, or an earlier start in the same document; strings are judged on the input.
    Returns per row doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept (bytes).

    Null text is empty; texts shorter than ``span`` stay whole. Rows that repeat doc_id and text are one
    document and get the same result; different texts under one doc_id, or under none, are documents of their own
    (a null doc_id is first, then by text hash). An empty table gives none.

    Not every suffix is sorted. A window of ``span`` bytes has an anchor, its least ``gram``-byte string, so equal
    windows have equal anchors; a segment is the windows that share an anchor. One shuffle by anchor
    finds equal segments, whose copies go as a whole, and anchors with several contents. The windows of these alone
    are suffixes to sort, each against those whose anchor has the same bytes and distance: a merge sort that compares
    two suffixes by binary search over prefix hashes and checks equal ones byte by byte. Anchors with very many contents are
    sorted in parts whose distinct windows are then grouped by their bytes.
    """
    keyed = _keyed(docs)
    found = keyed.select("key", "text").mapInArrow(_find_segments(span, gram), _SEGMENT)
    dealt = found.repartition("g").sortWithinPartitions("g", "copy", "c", "doc", "low")
    repeats = written(dealt.mapInArrow(_repeated, _SEGMENT))
    copies = repeats.filter("copy").select("doc", "low", (F.col("low") + F.col("high")).alias("high"))

    contested = repeats.filter("not copy")
    large = contested.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > _GROUP)
    parts = F.ceil(F.col("n") / _GROUP).cast("long")
    wanted = contested.groupBy("doc").agg(F.collect_list(F.struct("g", "low", "high", "at")).alias("parts"))
    cut = keyed.select("key", "text").join(wanted, F.col("key") == F.col("doc")).select("key", "text", "parts")
    cut = cut.mapInArrow(_cut_segments(span), "g long, doc long, low long, high long, at long, bytes binary")
    placed = cut.join(large, "g", "left").withColumn("part", F.pmod(F.xxhash64("doc", "low"), parts)).drop("n")
    sorted_ = placed.repartition("g", "part").sortWithinPartitions("g", "part").mapInArrow(_sort_segments(span), "doc long, start long, window binary")
    windows = written(sorted_)
    opened = windows.filter("window is not null")
    first = opened.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = opened.join(first, "window").filter(F.struct("doc", "start") != F.col("first")).select("doc", "start")
    single = windows.filter("window is null").select("doc", "start").unionByName(later)
    ranges = copies.unionByName(single.select("doc", F.col("start").alias("low"), F.col("start").alias("high")))
    per_doc = ranges.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    joined = keyed.join(per_doc, F.col("key") == F.col("doc"), "left").select("doc_id", "text", "ranges")
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.mapInArrow(_remove(span), kind)
