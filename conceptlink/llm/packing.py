"""Best-fit packing of tokenized documents after dominance reduction."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import slices
from conceptlink.operators.staging import written

END = 2
LONG_BLANKS = 1000
# the characters of the Unicode property White_Space, which the pre-token pattern means by \s; Python means a few more
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG = re.compile(f"{_BLANK}{{{LONG_BLANKS},}}")
# fixed value: the pre-token pattern of byte-level tokenizers of this family
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def encoder(path: str):
    """Byte-pair encoder of a tokenizers file.

    The file's vocabulary is in merge order, so it also serves as the ranks of the quicker encoder used here; tests
    hold its ids against those of the tokenizers library, and check that each vocabulary entry encodes to itself,
    without which the two could merge differently.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(printable)]
    byte_of = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(others)}
    special = {t["content"] for t in model["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("file", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _added(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """Pattern of the tokens that the file adds to the vocabulary, with the blanks they take in, and their ids.

    Such a token is found in the text before anything else, the leftmost and then the longest one.
    """
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    parts = []
    for t in sorted(added, key=lambda t: -len(t["content"])):
        word = f"({re.escape(t['content'])})"
        word = rf"(?<!\w){word}(?!\w)" if t["single_word"] else word
        parts.append(f"{_BLANK}*" * t["lstrip"] + word + f"{_BLANK}*" * t["rstrip"])
    return re.compile("|".join(parts)) if parts else None, {t["content"]: t["id"] for t in added}


def _plain_ids(path: str, text: str) -> Iterator[list[int]]:
    """Ids of a text without added tokens.

    A long run of blanks is one pre-token, but for its last blank if a word follows, so it can be cut out; the pattern itself gives up
    in runs of about a million.
    """
    coder, at = encoder(path), 0
    for run in _LONG.finditer(text) if len(text) >= LONG_BLANKS else ():
        end = run.end() - (run.end() < len(text))
        yield coder.encode_ordinary(text[at : run.start()])
        yield coder._encode_single_piece(text[run.start() : end].encode())
        at = end
    yield coder.encode_ordinary(text[at:] if at else text)


def token_ids(path: str, text: str) -> list[int]:
    """Ids of a text as tokenizers gives them without special tokens around it: names of added tokens inside it are those tokens."""
    pattern, ids = _added(path)
    out, at = [], 0
    for m in pattern.finditer(text) if pattern else ():
        for part in _plain_ids(path, text[at : m.start()]):
            out += part
        out.append(ids[m[m.lastindex]])
        at = m.end()
    for part in _plain_ids(path, text[at:]):
        out += part
    return out


def _tokenize(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in (part for whole in batches for part in slices(whole)):
            doc_ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc_id, text in zip(doc_ids, batch.column("text").to_pylist()):
                ids = np.array([*token_ids(path, text or ""), END], "<u4")
                n = (len(ids) + size - 1) // size
                start = 0
                for k in range(n):
                    stop = len(ids) - (n - 1 - k) * size
                    length = stop - start
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start:stop].tobytes()), part, seen[length]))
                    seen[length] += 1
                    start = stop
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def _reduce(left: list[int], cap: int) -> list[tuple[int, tuple[int, ...]]]:
    """Fix the sets that dominate every alternative for their largest item (Martello and Toth); ``left`` shrinks.

    For an item s the set {s} dominates if nothing else fits beside it, {s, cap - s} because one item stands in
    for whatever could fill the gap, and {s, t} with the largest t that fits if no two items fit beside s.
    """
    fixed = []

    def fix(*sizes: int) -> None:
        need = Counter(sizes)
        times = min(left[s] // n for s, n in need.items())
        if times:
            fixed.append((times, sizes))
            for s, n in need.items():
                left[s] -= n * times

    changed = True
    while changed:
        changed, before = False, sum(left)
        for s in range(cap, 0, -1):
            while left[s]:
                count, room = left[s], cap - s
                left[s] -= 1  # the item looked at is not its own neighbour
                small = [t for t in range(1, room + 1) if left[t]] if room else []
                pair = small and (2 * small[0] if left[small[0]] > 1 else sum(small[:2]) if len(small) > 1 else cap + 1)
                left[s] += 1
                if not small:
                    # other copies of s do not fit either, so all of them stand alone
                    fix(s)
                elif small[-1] == room or pair > room:
                    fix(s, small[-1])
                if left[s] == count:
                    break
        changed = sum(left) < before
    return fixed


def _best_fit(left: list[int], cap: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts of sizes; bins of the same content are one entry."""
    bins: dict[int, Counter] = defaultdict(Counter)  # room -> content -> number
    for s in range(cap, 0, -1):
        n = left[s]
        while n:
            room = min((r for r in bins if r >= s and bins[r]), default=None)
            if room is None:
                room, content, m = cap, (), n
            else:
                content, m = next(iter(bins[room].items()))
                del bins[room][content]
            q = room // s
            full = min(m, n // q)
            if full:
                bins[room - q * s][content + (s,) * q] += full
                n -= q * full
            used = full
            if n and n < q and used < m:
                bins[room - n * s][content + (s,) * n] += 1
                n, used = 0, used + 1
            if content and m > used:
                bins[room][content] += m - used
        left[s] = 0
    return [(m, content) for group in bins.values() for content, m in group.items()]


def pack_sizes(counts: dict[int, int], cap: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (how often, sizes) that hold ``counts`` items of each size in few bins of ``cap``.

    The instance is the count of each size, so its length is at most ``cap`` whatever the number of documents.
    """
    left = [0] * (cap + 1)
    for s, n in counts.items():
        left[s] += n
    return _reduce(left, cap) + _best_fit(left, cap)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024) -> DataFrame:
    """Token pieces of ``docs`` (doc_id, text) with their places in sequences of at most ``size`` tokens.

    A document is its token ids and one end mark. Only longer ones are cut: the last pieces are full, the first takes the rest. Null
    or empty text is the end mark alone. Repeated rows and rows without doc_id are documents of their own. An
    empty table gives none.

    The driver sees one count per size (at most ``size`` numbers). Each piece knows its place among the pieces of
    its size (a running number of its task and the counts of the tasks before), and the small table of patterns,
    bounded by ``size`` and not by the data, turns that into a sequence and an offset.
    """
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    cut = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenize(tokenizer_path, size), kind))
    per_task = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = per_task.selectExpr("length", "part", "sum(n) over (partition by length order by part) - n as before")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, taken, sequence = [], Counter(), 0
    for times, sizes in pack_sizes(counts, size):
        offset = 0
        for s in sizes:
            runs.append((s, taken[s], taken[s] + times, sequence, offset))
            taken[s] += times
            offset += s
        sequence += times
    places = cut.sparkSession.createDataFrame(runs or [(0, 0, 0, 0, 0)], "length long, low long, high long, sequence long, offset long")
    ranked = cut.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    return (
        ranked.join(F.broadcast(places), "length")
        .filter("rank >= low and rank < high")
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")
    )
