"""Personal data by fixed patterns, and by contexts learned from what the patterns find."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from conceptlink.llm.common import slices, texts
from conceptlink.operators.staging import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can begin inside a run of digits only if it can begin at the run's start, so starts inside are skipped
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9]{2}|@|[(\[]at[)\]]")
_AT = re.compile(r"\s?[(\[]at[)\]]\s?|\sat\s", re.IGNORECASE)
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\s?[(\[]dot[)\]]\s?|\sdot\s|\.)[A-Za-z0-9-]++)+", re.IGNORECASE)
# a run of digits is read whole, and none begins or ends inside a word
_GROUPS = re.compile(r"(?:\((?=[0-9])|(?<!\w))[0-9]++\)?(?:[ ./-]{1,2}\(?[0-9]++\)?)++(?!\w)")
_TRAIL = ".,;:!?\"')]}>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Works from each @ outwards, so a long run without one costs nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns, by kind and start; ends are exclusive."""
    out = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a written-out at sign: ``name at host dot org``, ``name (at) host.org``."""
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, m.end()) if start < m.start() else None
        if host:
            yield start, host.end()
            end = host.end()


def _number_runs(text: str) -> Iterator[tuple[int, int]]:
    """Neighbouring groups of digits with 7 to 19 digits in all, as local phone numbers are written."""
    for m in _GROUPS.finditer(text):
        a, b = m.span()
        if text[b - 1] == ")" and "(" not in m.group():
            b -= 1
        if 7 <= len(_DIGIT.findall(m.group())) <= 19:
            yield a, b


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Tokens without blanks that hold four digits or more, or a kind of @."""
    done = 0
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        a, b = m.span()
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        token = text[a:b].rstrip(_TRAIL)
        if len(token) >= 6 and ("@" in token or "at)" in token or "at]" in token or len(_DIGIT.findall(token)) >= 4):
            yield a, a + len(token)


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans that look like identifiers, in order; none touches a taken one, and forms named first go before the others."""
    busy = sorted((a, b) for _, a, b in taken)
    out: list[tuple[int, int]] = []
    for form in (_spelled, _number_runs, _tokens):
        k, new = 0, []
        for a, b in form(text):
            while k < len(busy) and busy[k][1] <= a:
                k += 1
            if k == len(busy) or busy[k][0] >= b:
                new.append((a, b))
        out += new
        busy = sorted(busy + new)
    return sorted(out)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)


def _words(text: str, at: int, n: int, step: int) -> list[str]:
    """The ``n`` words next to ``at``, before it (``step`` -1) or after it (1), as they stand in the text; fewer at its edge."""
    size = 32
    while True:
        a, b = (max(0, at - size), at) if step < 0 else (at, at + size)
        found = text[a:b].split()
        # a word at the far end may be cut
        whole = found if (a == 0 if step < 0 else b >= len(text)) else found[1:] if step < 0 else found[:-1]
        if len(whole) >= n or whole is found:
            return whole[-n:] if step < 0 else whole[:n]
        size *= 4


def _contexts(text: str, start: int, end: int) -> list[int]:
    """Lexical patterns around a span: the two words before it, and one word on each side; none at the text's edge."""
    left = [w.lower() for w in _words(text, start, 2, -1)]
    right = [w.lower() for w in _words(text, end, 1, 1)]
    out = []
    if len(left) > 1:
        out.append(_hash("before", *left))
    if left and right:
        out.append(_hash("around", left[-1], right[0]))
    return out


_FOUND = "doc_id long, base array<struct<kind:int,low:int,high:int>>, seen array<struct<kind:int,low:int,high:int,instance:bigint,patterns:array<bigint>>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("kind", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]
    seen_type = pa.struct([*span, ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    for batch in (part for whole in batches for part in slices(whole)):
        bases, seens = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans = base + [(-1, a, b) for a, b in _candidates(text, base)]
            bases.append([dict(zip(("kind", "low", "high"), s)) for s in base])
            seens.append([{"kind": k, "low": a, "high": b, "instance": _hash(text[a:b].lower()), "patterns": _contexts(text, a, b)} for k, a, b in spans])
        cols = [batch.column("doc_id"), pa.array(bases, pa.list_(pa.struct(span))), pa.array(seens, pa.list_(seen_type))]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "base", "seen"])


def learned_patterns(seen: DataFrame, support: int = 3, least: float = 0.8) -> DataFrame:
    """(pattern, kind, score) of the contexts that hold almost only one kind of personal data.

    ``seen`` has an instance, its kind (-1: unknown) and a pattern per row. An entity of known kind scores 1. A pattern
    scores the sum of its instances' scores over the number of its distinct instances; one with at least
    ``support`` scored instances and a score of ``least`` is accepted with that score and vouches for its other instances,
    which get 1 - product(1 - score) over such patterns and may raise more patterns in the next round. Copies of one text add
    nothing, since instances are counted once. Rounds go on until one accepts no pattern; accepted ones keep their
    scores, so nothing could change after that.
    """
    edges = written(seen.select("pattern", "instance", "kind").distinct())
    links = edges.select("pattern", "instance").distinct()
    totals = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    seeds = edges.filter("kind >= 0").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    scores, good = seeds, None
    while True:
        held = links.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("n"))
        rated = held.filter(F.col("n") >= support).join(totals, "pattern").withColumn("score", F.col("sum") / F.col("total"))
        rated = rated.filter(F.col("score") >= least).select("pattern", "kind", "score")
        new = written(rated if good is None else rated.join(good, ["pattern", "kind"], "left_anti"))
        if new.isEmpty():
            return new if good is None else good
        good = new if good is None else written(good.unionByName(new))
        miss = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-6))))
        vouched = links.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(miss)).alias("score"))
        both = vouched.unionByName(seeds).groupBy("instance", "kind").agg(F.max("score").alias("score"))
        scores = written(both)


def _listed(spans: F.Column) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["low"].cast("string"), s["high"].cast("string")))
    return F.array_join(text, ",")


def find_personal_data(docs: DataFrame, support: int = 3, least: float = 0.8) -> DataFrame:
    """Spans of personal data in ``docs`` (doc_id, text, ...).

    Returns per row doc_id, base (spans of the fixed patterns) and spans (with those of learned contexts), both arrays of
    kind number, start and end in code points, by kind and start. A learned span never overlaps a base span and has
    the kind whose context scores best (the first kind on a tie). It is a token without blanks, a run of neighbouring
    groups of digits (``555 123 4567``) or a spelled-out address (``name at host dot org``); contexts are the words outside it.

    Null text is empty. Repeated rows get equal results, null doc_ids are kept; an empty table gives none. Texts are read
    whole, however long. Further columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find, _FOUND)
    found = written(rows.withColumn("row", F.monotonically_increasing_id()))
    seen = found.select("row", F.explode("seen").alias("s")).select("row", "s.kind", "s.low", "s.high", "s.instance", F.explode("s.patterns").alias("pattern"))
    good = learned_patterns(seen, support, least)
    hits = seen.filter("kind < 0").drop("kind").join(good, "pattern")
    best = hits.groupBy("row", "low", "high").agg(F.max_by("kind", F.struct("score", (-F.col("kind")).alias("k"))).alias("kind"))
    learned = best.groupBy("row").agg(F.collect_list(F.struct("kind", "low", "high")).alias("more"))
    joined = found.select("row", "doc_id", "base").join(learned, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,low:int,high:int>>"))))
    return joined.select("doc_id", "base", spans.alias("spans"))


def _number_of(kind: int) -> F.Column:
    # a lambda with a second parameter would get an element's index there, even if it has a default
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def span_report(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    counts = [_number_of(i).alias(f"n_{name}") for i, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
