"""Reply trees to chat transcripts: the best path of each tree, formatted reversibly with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from conceptlink.llm.chains import reached
from conceptlink.operators.staging import written

START, STOP = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """Put one more backslash between < and |, so no control string is left; ``unescape`` takes it away."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Transcript of (role, text) turns, and the code point ranges that count for the loss: assistant texts."""
    out, at, mask = [], 0, []
    for role, text in turns:
        head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
        body = escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, STOP, "\n"]
        at += len(head) + len(body) + len(STOP) + 1
    return "".join(out), mask


def parse_turns(transcript: str) -> list[tuple[str, str]]:
    """Turns of a transcript; the inverse of ``format_turns``."""
    turns, at = [], 0
    while at < len(transcript):
        line = transcript.index("\n", at)
        end = transcript.index(STOP, line)
        role = unescape(transcript[at + len(START) : line])
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
        turns.append((role, unescape(transcript[line + 1 : end])))
        at = end + len(STOP) + 1
    return turns


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    for batch in batches:
        texts, masks = [], []
        for turns in batch.column("turns").to_pylist():
            text, mask = format_turns([(t["role"] or "", t["text"] or "") for t in turns])
            texts.append(text)
            masks.append([{"low": a, "high": b} for a, b in mask])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(masks, span)], ["conv_id", "transcript", "loss"])


def chosen_paths(nodes: DataFrame) -> DataFrame:
    """Nodes of the best root-to-leaf path of each conversation, with ``depth``.

    ``nodes`` has conv_id, node (unique), parent (null, or no node: a root) and score. Self-joins double the known part of
    every path until it ends at a root. A branch is ranked by the mean score of its path (null counts as 0), ties by
    the smallest leaf. Nodes of a cycle have no root and are left out.
    """
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("exists"))
    linked = nodes.join(known, "parent", "left").select("conv_id", "node", F.when(F.col("exists"), F.col("parent")).alias("parent"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    linked = written(linked)
    paths = linked.select("node", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    open_before = None
    while True:
        paths = written(paths)
        still = paths.filter("top is not null").count()
        if still in (0, open_before):
            break
        open_before = still
        above = paths.select(F.col("node").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"), F.col("total").alias("add"))
        # finished paths stay out of the join
        longer = paths.filter("top is not null").join(above, "top").select(
            "node", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("add")).alias("total")
        )
        paths = paths.filter("top is null").unionByName(longer)
    rooted = linked.join(paths.filter("top is null").select("node", "depth", "total"), "node")
    inner = linked.filter("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = rooted.join(inner, "node", "left_anti")
    best = leaves.groupBy("conv_id").agg(F.max_by("node", F.struct(F.col("total") / F.col("depth"), -F.col("node"))).alias("node"))
    links = linked.select("node", F.col("parent").alias("next"))
    return rooted.join(reached(best, links), "node", "left_semi").select("conv_id", "node", "depth")


def format_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, transcript and loss (code point ranges) of the best path of each reply tree in ``messages``.

    ``messages`` has conv_id, node, parent, score, role, text. Null roles and texts are empty; messages without
    conv_id are one conversation. An empty table gives none.
    """
    path = chosen_paths(messages.select("conv_id", "node", "parent", "score"))
    turns = messages.select("node", "role", "text").join(path, "node")
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    return listed.mapInArrow(_format, "conv_id long, transcript string, loss array<struct<low:bigint,high:bigint>>")


def as_tree(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, ...) as reply trees: each turn answers the one before; equal turns keep their input order."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = written(rows.withColumn("node", F.monotonically_increasing_id()))
    order = Window.partitionBy("conv_id").orderBy("turn", "node")
    parents = rows.select("conv_id", "turn", "node").withColumn("parent", F.lag("node").over(order)).select("node", "parent")
    return rows.join(parents, "node").select("conv_id", "node", "parent", F.lit(0.0).alias("score"), "role", "text")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "transcript", "loss"))):
            turns = parse_turns(text)
            learned = "".join(unescape(text[s["low"] : s["high"]]) for s in loss)
            digest = hashlib.sha256()
            for role, said in turns:
                digest.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
            rows.append((conv, len(turns), digest.hexdigest(), len(learned), hashlib.sha256(learned.encode("utf-8", "replace")).hexdigest(), len(text)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(cols, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def transcript_report(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from formatted conversations: turns, their digest, and the text under the loss mask."""
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(_report, kind)
