"""Conversation prefix tries: radix trees of turn ids in the tasks, merged by the digest of a prefix."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from conceptlink.llm.radix import RadixTree
from conceptlink.operators.ranking import running_totals
from conceptlink.operators.staging import written

WIDTH = 16  # bytes of a turn id and of a prefix digest
PART = 4096  # turns of one string; a longer conversation is several
_HELD = 1 << 16  # turns in one tree
_HOT = 1000  # a parent of more than one thousandth of all nodes is sent to all tasks: there are fewer than that
_CHUNK = 1 << 16  # characters of a list of ids in one row
ROOT = bytes(WIDTH)

_KEY = "conv_id long, part int, start binary, ids array<binary>, words array<int>, own long, leaf long, later long, last boolean"
_NODE = "node binary, parent binary, depth long, n long, least long, leaves long, saved long, ends array<long>"


def _digest(*columns: Column) -> Column:
    """Leading bytes of the SHA-256 of the columns' bytes."""
    whole = F.concat(*[c.cast("binary") for c in columns])
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * WIDTH))


def rebuilt_turns(conversations: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, id, words) of the rebuilt conversations, and all their ids.

    A conversation c is the first h turns of conversation c - c % ``family`` and then its own turns after its first h; h is the CRC-32
    of the decimal c modulo ``heads``. A turn's id is a digest of its role and text, which stay behind.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"),
        F.col("turn").alias("turn"),
        _digest(F.char_length(role).cast("string"), F.lit(":"), role, text).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("one", F.lit(1)))
    ranked = running_totals(rows, ["turn", "id", "at"], {"one": "nth"}, ["conv_id"])
    ranked = ranked.select("conv_id", (F.col("nth") - 1).alias("pos"), "id", "words")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), head.alias("head"))
    based = convs.join(sizes.select(F.col("conv_id").alias("base"), "size"), "base", "left")
    # where the base has too few turns, the conversation's own turns move up
    based = written(based.select("conv_id", "base", "head", F.greatest(F.col("head") - F.coalesce("size", F.lit(0)), F.lit(0)).alias("gap")))
    first = ranked.filter(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "id", "words")
    taken = based.join(first, "base").filter("pos < head").select("conv_id", "pos", "id", "words")
    own = ranked.filter(F.col("pos") >= head).join(based.filter("gap > 0").select("conv_id", "gap"), "conv_id", "left")
    own = own.select("conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "id", "words")
    return taken.unionByName(own), sizes.select("conv_id")


def _chain(rows):
    """Digest of what lies before each part of one long conversation; a row here stands for thousands of turns."""
    rows = rows.sort_values("part")
    start, out = ROOT, []
    for part, inner in zip(rows["part"], rows["inner"]):
        out.append((part, start))
        start = hashlib.sha256(start + inner).digest()[:WIDTH]
    parts, starts = zip(*out)
    return pd.DataFrame({"conv_id": rows["conv_id"].iloc[0], "part": parts, "start": starts, "last": [p == parts[-1] for p in parts]})


def turn_strings(turns: DataFrame, convs: DataFrame, part: int = PART) -> DataFrame:
    """One row per conversation, or per ``part`` turns of a longer one: its turn ids and word counts in order, and the digest before it."""
    none = convs.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).alias("words"))
    placed = turns.select("conv_id", F.col("pos").cast("long").alias("pos"), "id", "words").unionByName(none)
    at = F.floor(F.greatest("pos", F.lit(0)) / part).cast("int")
    lists = placed.groupBy("conv_id", at.alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("turns"))
    real = F.filter("turns", lambda t: t["pos"] >= 0)
    lists = written(lists.select("conv_id", "part", real["id"].alias("ids"), real["words"].alias("words")))
    if not lists.filter("part > 0").limit(1).count():
        return lists.withColumn("start", F.lit(ROOT)).withColumn("last", F.lit(True))
    long = lists.join(lists.filter("part > 0").select("conv_id").distinct(), "conv_id")
    inner = F.unhex(F.sha2(F.unhex(F.array_join(F.transform("ids", F.hex), "")), 256))
    starts = long.select("conv_id", "part", inner.alias("inner")).groupBy("conv_id").applyInPandas(_chain, "conv_id long, part int, start binary, last boolean")
    out = lists.join(starts, ["conv_id", "part"], "left")
    return written(out.withColumn("start", F.coalesce("start", F.lit(ROOT))).withColumn("last", F.coalesce("last", F.lit(True))))


def _tree_nodes(keys: list[tuple], part: int) -> pa.RecordBatch:
    """Nodes of the tree of some strings with what these strings add to them.

    ``keys`` are (conv_id, part, start, ids, words, own, leaf, later, last). The tree holds the digest before a string and then its
    turn ids; a node is emitted only where whole turns end.
    """
    tree, words, parts = RadixTree(), {}, {}
    for conv, at, start, ids, counts, own, leaf, later, last in keys:
        parts[start] = at
        words.update(zip(ids, counts))
        tree.insert(start + b"".join(ids), (conv, own, leaf, later, last))
    # places where whole turns end, parents first
    node, parent, depth, count, up = [], [], [], [], []
    n, least, first_own, leaves, saved, ends = [], [], [], [], [], []
    # last place, hash of the turn ids before, digest before them, and the begun turn at the end of each edge, by its end and depth
    open_at: list[tuple] = [(0, -1, None, None, b"")]
    for begin, edge, branch in tree.walk():
        while open_at[-1][0] > begin:
            open_at.pop()
        _, place, running, start, begun = open_at[-1]
        raw = begun + edge
        if running is not None:
            running = running.copy()
        for i in range(0, len(raw) - len(raw) % WIDTH, WIDTH):
            block = raw[i : i + WIDTH]
            if start is None:
                start, running = block, hashlib.sha256()
                node.append(start)
                parent.append(None)
                depth.append(parts[start] * part)
                count.append(0)
            else:
                running.update(block)
                node.append(hashlib.sha256(start + running.digest()).digest()[:WIDTH])
                parent.append(node[place])
                depth.append(depth[place] + 1)
                count.append(words[block])
            up.append(place)
            place = len(node) - 1
            for column, value in ((n, 0), (least, None), (first_own, None), (leaves, 0), (saved, 0), (ends, [])):
                column.append(value)
        for conv, own, leaf, later, last in branch.values:
            n[place] += 1
            least[place] = conv if least[place] is None else min(least[place], conv)
            first_own[place] = own if first_own[place] is None else min(first_own[place], own)
            leaves[place] += leaf
            saved[place] += later
            if last:
                ends[place].append(conv)
        open_at.append((begin + len(edge), place, running, start, raw[len(raw) - len(raw) % WIDTH :]))
    for i in range(len(node) - 1, -1, -1):
        if count[i]:  # all but the string of the node's smallest conversation repeat its text
            saved[i] += (n[i] - (first_own[i] <= depth[i])) * count[i]
        j = up[i]
        if j >= 0:
            n[j] += n[i]
            leaves[j] += leaves[i]
            saved[j] += saved[i]
            least[j] = least[i] if least[j] is None else min(least[j], least[i])
            first_own[j] = first_own[i] if first_own[j] is None else min(first_own[j], first_own[i])
    # the place before a later part is the last one of the part before, whose strings count it
    keep = [i for i in range(len(node)) if up[i] >= 0 or not depth[i]]
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    columns = (node, parent, depth, n, least, leaves, saved, ends)
    names = ["node", "parent", "depth", "n", "least", "leaves", "saved", "ends"]
    return pa.RecordBatch.from_arrays([pa.array([c[i] for i in keep], k) for c, k in zip(columns, kinds)], names)


def _trees(part: int, held: int):
    names = [f.split()[0] for f in _KEY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for key in zip(*(piece.column(c).to_pylist() for c in names)):
                    keys.append(key)
                    size += len(key[3]) + 1
                    if size >= held:
                        yield _tree_nodes(keys, part)
                        keys, size = [], 0
        if keys:
            yield _tree_nodes(keys, part)

    return run


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined runs of the ids that end at one node, from rows ordered by node and id."""
    out: list[tuple] = []
    node, low, ids, size = None, None, [], 0

    def give():
        cols = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.string()))], ["node", "low", "ids"])

    for batch in batches:
        for k, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
            if k != node or size > _CHUNK:
                if ids:
                    out.append((node, low, ",".join(ids)))
                node, low, ids, size = k, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if len(out) > 4096:
            yield give()
            out = []
    if ids:
        out.append((node, low, ",".join(ids)))
    if out:
        yield give()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list of ids from its ordered runs; only the running hash is held."""
    node, running, out = None, None, []

    def give():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.string()))], ["node", "ends_sha256"])

    for batch in batches:
        for k, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if k != node:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = k, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if len(out) > 4096:
            yield give()
            out = []
    if node is not None:
        out.append((node, running.hexdigest()))
    if out:
        yield give()


def _end_digests(nodes: DataFrame) -> DataFrame:
    """(node, ends_sha256). Ids are ordered by all tasks together; a node's digest then reads its runs of many thousand ids in one
    task, since a hash of one text cannot be split."""
    ordered = nodes.select("node", F.explode("ends").alias("conv")).orderBy("node", "conv")
    runs = ordered.mapInArrow(_join_ids, "node binary, low long, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "low").select("node", "ids").mapInArrow(_hash_ids, "node binary, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, part: int = PART, held: int = _HELD) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt ``conversations`` (conv_id, turn, role, text, ...): see :func:`rebuilt_turns`.

    Columns: conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. The members of a node are the conversations that begin with its turns.

    Turns are ordered by ``turn``, null first; equal ones by the digest of role and text. Null roles and texts are empty, so is a
    text of blanks as to its words. Repeated rows are turns of their own. Rows without conv_id belong to no
    conversation. A conversation all of whose turns are replaced by none is a member of the root. Very long texts
    are only hashed and counted. Other columns are not read. An empty table gives no node.

    Tasks put strings of 16-byte turn ids into adaptive radix trees of bounded size and give out each tree's nodes with partial
    sums; equal prefixes of different trees meet by digest. A common prefix thus costs one row per tree, not one per conversation.
    Sums over a subtree need no walk down the merged trie: a node belongs to its smallest member, so a conversation knows how
    many of its turns are its own, and a second pass of the trees adds up what each conversation brings to the nodes on its path.
    A conversation of more than ``part`` turns is several strings, chained by digests.
    """
    turns, convs = rebuilt_turns(conversations)
    keys = written(turn_strings(turns, convs, part))
    names = [f.split()[0] for f in _KEY.split(", ")]
    zero = F.lit(0).cast("long")
    plain = keys.withColumns({"own": zero, "leaf": zero, "later": zero})
    found = plain.select(*names).mapInArrow(_trees(part, held), _NODE)
    nodes = written(found)
    merged = written(nodes.groupBy("node", "parent", "depth").agg(F.sum("n").alias("n"), F.min("least").alias("least")))
    children = merged.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    merged = written(merged.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    # a conversation's own turns are its last ones; it owns a leaf if its whole text does
    owned = merged.groupBy(F.col("least").alias("conv_id")).agg(F.count(F.lit(1)).alias("nodes"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    sizes = keys.groupBy("conv_id").agg(F.sum(F.size("ids")).alias("size"))
    about = sizes.join(owned, "conv_id", "left").select("conv_id", (F.col("size") + 1 - F.coalesce("nodes", F.lit(0))).alias("own"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    known = keys.join(about, "conv_id")
    repeated = F.greatest(F.least(F.col("own") - 1 - F.col("part") * part, F.size("ids").cast("long")), zero).cast("int")
    shared = F.aggregate(F.slice("words", F.lit(1), repeated), zero, lambda a, x: a + x)
    after = Window.partitionBy("conv_id").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("shared", shared).withColumn("later", F.coalesce(F.sum("shared").over(after), zero))
    sums = known.select(*names).mapInArrow(_trees(part, held), _NODE).groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    whole = written(merged.join(sums, "node").join(_end_digests(nodes), "node", "left"))
    size = whole.count()
    ids = whole.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(ids.filter(F.col("n_children") * _HOT > size).select("parent", F.col("parent_conv_id").alias("hot_id")))
    near = whole.join(hot, "parent", "left")
    rest = near.filter("hot_id is null").join(ids.drop("n_children"), "parent", "left")
    both = rest.unionByName(near.filter("hot_id is not null").withColumn("parent_conv_id", F.col("hot_id")))
    empty = hashlib.sha256(b"").hexdigest()
    return both.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
