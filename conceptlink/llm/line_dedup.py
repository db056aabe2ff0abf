"""Lines that many documents share, removed everywhere but in one document. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from conceptlink.operators.staging import written

_BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lower-cased; other letters keep their case."""
    bare = F.trim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_HOT = 1000  # a line of more than one thousandth of all lines goes to all tasks: there are fewer than that


def _dropped(docs: DataFrame, row: Column, min_chars: int, min_docs: int) -> DataFrame:
    """``(id, mark, drop)``: positions of the lines that each text loses, for those that lose any."""
    line = (
        # the text is hashed before it is exploded, not once more for each of its lines
        docs.select(F.col("doc_id").alias("id"), row.alias("mark"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("parts"))
        .select("id", "mark", F.posexplode("parts").alias("pos", "line"))
        .filter(F.col("id").isNotNull() & (F.octet_length("line") >= min_chars))
        .select("id", "mark", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
    )
    lines = written(line.select("id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key", F.lit(11)).alias("h2")))
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"), F.count(F.lit(1)).alias("rows"))
        .filter(F.col("n") >= min_docs)
    )
    shared = written(shared.select("h1", "h2", "keeper", "rows"))
    hot = F.col("rows") * _HOT > lines.count()
    common = F.broadcast(shared.filter(hot).select("h1", "h2", F.col("keeper").alias("common")))
    near = lines.join(common, ["h1", "h2"], "left")
    rest = near.filter("common is null").drop("common").join(shared.filter(~hot).drop("rows"), ["h1", "h2"])
    found = rest.unionByName(near.filter("common is not null").withColumnRenamed("common", "keeper"))
    return found.filter("id <> keeper").groupBy("id", "mark").agg(F.collect_set("pos").alias("drop"))


def _without(parts: Column, drop: Column) -> Column:
    """The elements of ``parts`` whose positions are not in ``drop``: both are sorted together, so the cost is not their product."""
    kept = F.transform(parts, lambda x, i: F.struct(i.alias("pos"), F.lit(0).alias("gone"), x.alias("line")))
    gone = F.transform(drop, lambda i: F.struct(i.alias("pos"), F.lit(1).alias("gone"), F.lit("").alias("line")))

    def stays(s: Column) -> Column:
        return F.filter(s, lambda x, j: (x["gone"] == 0) & ~F.coalesce(F.get(s, j + 1)["gone"] == 1, F.lit(False)))

    # the sorted list is bound once
    return F.transform(F.array(F.sort_array(F.concat(kept, gone))), lambda s: F.transform(stays(s), lambda x: x["line"]))[0]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: bool = True) -> DataFrame:
    """Drop repeated lines from ``docs`` (doc_id, text, ...).

    A key of at least ``min_chars`` code points found in at least ``min_docs`` distinct documents loses all
    its lines except those of the largest doc_id that holds it. All columns stay, ``text`` is the rest joined by
    newlines, and with ``counts`` ``n_lines`` and ``n_dropped`` are added (a column of that name is replaced); other names may
    be any.

    Null or empty text is one empty line. A row without doc_id is no document: it is not counted and keeps its
    lines. Rows that repeat a doc_id count as one document and are treated alike; a line that repeats within its document is
    kept or dropped at all places. A very long text is one row, and costs its lines times their logarithm. An empty table gives none.

    Lines are hashed to 128 bits and only (hash, document, position) is shuffled. Distinct documents are counted in two steps, first by
    hash and document and then by hash. Of the common lines, those of more than one thousandth of all
    lines, fewer than a thousand, go to all tasks, so their occurrences do not meet in one; the others are joined by hash. The text moves once, to
    meet the positions to drop.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.xxhash64(text)
    drops = _dropped(docs, row, min_chars, min_docs).select("id", "mark", F.struct("drop").alias("found"))
    # the input is one struct, so no name in it can clash
    whole = docs.select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"), row.alias("mark"), text.alias("whole"))
    joined = whole.join(drops, ["id", "mark"], "left").select("doc", "whole", "found.drop")
    parts = F.split("whole", "\n", -1)
    left = F.when(F.col("drop").isNull(), F.col("whole")).otherwise(F.array_join(_without(parts, F.col("drop")), "\n"))
    more = {"n_lines": F.size(parts).cast("long"), "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("long")} if counts else {}
    new = {"text": left} | more
    old = [new.pop(c).alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return joined.select(*old, *[v.alias(c) for c, v in new.items()])
