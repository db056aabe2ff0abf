"""Density hierarchy: minimum spanning forest by rounds, condensed tree, and its most stable clusters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from conceptlink.operators.components import connected_components
from conceptlink.operators.density import NOISE, reachability_edges
from conceptlink.operators.staging import written

_TINY = 1e-9  # smaller distances count as this, so that the density stays finite


@dataclass(frozen=True)
class DensityHierarchy:
    """``tree``: (cluster, parent, size, birth, stability, chosen). A cluster is named by the edge (a, b) whose merge made it; ``birth`` is
    the density (1 / distance) at which it parts from its parent. ``members``: (id, cluster, fell, cluster_id), the smallest cluster
    that holds a point, the density at which the point leaves it, and the chosen cluster it is in, named by its smallest id, or -1."""

    tree: DataFrame
    members: DataFrame

    def labels(self) -> DataFrame:
        return self.members.select("id", "cluster_id")


def _merge_rounds(points: DataFrame, edges: DataFrame, m: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Splits (cluster, parent, e), falls (id, cluster, e) and top clusters of the single-linkage tree of ``edges`` (a, b, w).

    Each round every group of points takes its shortest edge to another one (e: weight and ends, so no two are equal).

    * Where the edges of small groups lead to a large one, over ever shorter edges, they join it, each at its own edge: whatever they
      touch on the way is in the large group before. Their points fall out there.
    * Where they lead to a pair of small groups that took the same edge, the groups merge one after another in the order of their edges, with
      running sums of their sizes, up to the first edge that is longer than one leading elsewhere. The first merge with at least ``m``
      points begins a cluster; what comes after it falls out of that.
    * Two large groups that took the same edge are the parts into which a cluster splits. Where the edges of other large groups lead to
      them over large ones only, these join in the order of their edges, each a split of its own, up to the first edge that is longer than one
      leading elsewhere. So a cluster that takes up one large group after another needs no round for each.

    All this contracts edges of the spanning forest, so the order between groups does not matter but for the cluster
    that a point falls out of; ``_climb`` finds that at the end.
    """
    name = F.struct("e.a", "e.b")
    kind = edges.select(F.struct("a", "b").alias("c")).schema["c"].dataType
    # a small group knows its points, fewer than m; a large one its cluster
    nodes = points.select(F.col("id").alias("u"), F.array("id").alias("ids"), F.lit(None).cast(kind).alias("cluster"))
    current = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v"), F.struct("w", "a", "b").alias("e")))
    splits, falls = [], []
    order = Window.partitionBy("component").orderBy("e", "u")
    before, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    whole, chain = Window.partitionBy("component"), Window.partitionBy("chain")
    in_order = chain.orderBy("e", "u")
    ahead, up_to = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, 0)
    while current.limit(1).count():
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v"), "e"))
        picks = both.groupBy("u").agg(F.min(F.struct("e", "v")).alias("p")).select("u", "p.e", "p.v")
        picks = written(picks.join(nodes, "u"))
        small = picks.filter("cluster is null")
        groups = connected_components(picks.select(F.col("u").alias("id")), small.select(F.col("u").alias("src"), F.col("v").alias("dst")))
        groups = written(groups.toDF("u", "component"))

        # large groups
        big = picks.filter("cluster is not null")
        linked = big.join(big.select(F.col("u").alias("v")), "v", "left_semi").select(F.col("u").alias("src"), F.col("v").alias("dst"))
        chains = written(connected_components(big.select(F.col("u").alias("id")), linked).toDF("u", "chain"))
        beyond = both.join(chains, "u").join(chains.toDF("v", "other"), "v", "left").filter("other is null or other <> chain")
        beyond = beyond.groupBy("u").agg(F.min("e").alias("out"))
        row = big.drop("v", "ids").join(chains, "u").join(beyond, "u", "left").withColumn("first", F.min("e").over(chain))
        row = row.withColumn("sides", F.sum(F.when(F.col("e") == F.col("first"), 1).otherwise(0)).over(chain)).filter("sides = 2")
        row = row.withColumn("out", F.min("out").over(ahead))
        beaten = F.when((F.col("e") > F.col("first")) & (F.col("e") > F.col("out")), 1).otherwise(0)
        row = row.withColumn("late", F.sum(beaten).over(up_to)).filter("late = 0").withColumn("place", F.row_number().over(in_order))
        grown_from = F.when(F.col("place") == 2, F.lag("cluster").over(in_order)).otherwise(F.lag(name.cast(kind)).over(in_order))
        top = F.max("e").over(chain)
        row = row.withColumn("other", grown_from).withColumn("into", F.min("u").over(chain)).withColumn("top", top)
        pairs = written(row.select("u", "cluster", "e", "other", "into", F.struct("top.a", "top.b").cast(kind).alias("top"), name.cast(kind).alias("parent"), "place"))
        splits.append(pairs.filter("place > 1").select(F.explode(F.array("cluster", "other")).alias("cluster"), "parent", "e"))
        joined = pairs.select("u", "into", F.col("top").alias("cluster"))
        large = picks.filter("cluster is not null").select("u", "cluster").join(joined.select("u", "into"), "u", "left").withColumn("into", F.coalesce("into", "u"))
        held = large.join(groups, "u").select("component", F.col("cluster").alias("at"), F.col("into").alias("host"))

        # small groups
        where = groups.withColumnRenamed("component", "other")
        away = both.join(groups, "u").join(where.withColumnRenamed("u", "v"), "v").filter("component <> other")
        out = away.groupBy("u").agg(F.min("e").alias("out"))
        rows = small.drop("v", "cluster").join(groups, "u").join(held, "component", "left").join(out, "u", "left")
        rows = rows.withColumn("left", F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0))).withColumn("out", F.min("out").over(before))
        late = F.col("at").isNull() & (F.col("left") < m) & (F.col("e") > F.col("out"))
        rows = rows.withColumn("late", F.sum(F.when(late, 1).otherwise(0)).over(so_far)).filter("late = 0")
        made = F.col("at").isNull() & (F.col("left") < m) & (F.col("left") + F.size("ids") >= m)
        rows = rows.withColumn("base", F.max(F.when(made, F.col("e"))).over(whole)).withColumn("into", F.coalesce("host", F.min("u").over(whole)))
        rows = written(rows.withColumn("cluster", F.coalesce("at", F.when(F.col("base").isNotNull(), F.struct("base.a", "base.b").cast(kind)))))
        fell = rows.filter("cluster is not null").select(F.explode("ids").alias("id"), "cluster", F.coalesce(F.greatest("e", "base"), F.col("e")).alias("e"))
        falls.append(fell)

        met = rows.filter("host is null").groupBy(F.col("into").alias("u")).agg(F.flatten(F.collect_list(F.when(F.col("cluster").isNull(), F.col("ids")))).alias("ids"), F.first("cluster").alias("cluster"))
        grown = joined.filter("u = into").select("u", F.lit(None).cast(met.schema["ids"].dataType).alias("ids"), "cluster")
        gone = rows.select("u", "into").unionByName(joined.select("u", "into"))
        nodes = written(nodes.join(gone.select("u"), "u", "left_anti").unionByName(met).unionByName(grown))
        moved = current.join(gone.toDF("u", "x"), "u", "left").join(gone.toDF("v", "y"), "v", "left")
        x, y = F.coalesce("x", "u"), F.coalesce("y", "v")
        moved = moved.filter(x != y).select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"), "e")
        current = written(moved.groupBy("u", "v").agg(F.min("e").alias("e")))
    return _union(splits), _union(falls), nodes.filter("cluster is not null").select("cluster")


def _union(parts: list[DataFrame]) -> DataFrame | None:
    whole = None
    for p in parts:
        whole = p if whole is None else whole.unionByName(p)
    return whole


def _climb(falls: DataFrame, splits: DataFrame) -> DataFrame:
    """Falls from the cluster that is there at the fall's edge: up from the cluster noted, as long as that has merged into its parent before.

    Merges are later the further up, so a fall tries hops over ever fewer levels, each half as far as the one before.
    """
    hops = [written(splits.select("cluster", "parent", F.col("e").alias("merged")))]
    while True:
        on = hops[-1].select(F.col("cluster").alias("parent"), F.col("parent").alias("far"), F.col("merged").alias("later"))
        hop = hops[-1].join(on, "parent").select("cluster", F.col("far").alias("parent"), F.col("later").alias("merged"))
        hop = written(hop)
        if not hop.limit(1).count():
            break
        hops.append(hop)
    for hop in reversed(hops):
        here = F.when(F.col("merged") < F.col("e"), F.col("parent")).otherwise(F.col("cluster"))
        falls = falls.join(hop, "cluster", "left").select("id", here.alias("cluster"), "e")
    return falls


_NEVER = float("-inf")


def _fold_up(nodes: DataFrame) -> DataFrame:
    """``(node, value)`` of a binary forest ``nodes`` (node, parent, least, plus, open): a node is worth ``plus`` and the worth of its ``open`` (0 or 2)
    parts, and ``least`` at least.

    Leaves pass their worth up, and chains of nodes that wait for one part are cut out of the tree: steps "at least s, or c more
    than below" make such a step again, so pointers down a chain double. Each round at least halves the tree, however deep
    it is. The nodes of a chain are worth what their joined step makes of the chain's end, once that is known.
    """
    # a node hands up what its own step (es, ec) makes of its worth
    waiting = written(nodes.select("node", "parent", "least", "plus", "open", F.lit(_NEVER).alias("es"), F.lit(0.0).alias("ec")))
    done, late = [], []
    while True:
        ready = waiting.filter("open = 0").withColumn("value", F.greatest("least", "plus"))
        ready = written(ready.select("node", "parent", "value", F.greatest("es", F.col("ec") + F.col("value")).alias("up")))
        done.append(ready.select("node", "value"))
        sums = ready.groupBy(F.col("parent").alias("node")).agg(F.sum("up").alias("more"), F.count(F.lit(1)).alias("n"))
        rest = waiting.filter("open > 0").join(sums, "node", "left")
        plus, left = F.col("plus") + F.coalesce("more", F.lit(0.0)), F.col("open") - F.coalesce("n", F.lit(0))
        rest = written(rest.select("node", "parent", "least", plus.alias("plus"), left.cast("int").alias("open"), "es", "ec"))
        if not rest.limit(1).count():
            break
        part = rest.select(F.col("parent").alias("node"), F.col("node").alias("down"), F.col("es").alias("s"), F.col("ec").alias("c"))
        low = F.greatest(F.col("least"), F.col("plus") + F.col("s"))
        chain = rest.filter("open = 1").join(part, "node")
        chain = written(chain.select("node", "parent", "down", low.alias("s"), (F.col("plus") + F.col("c")).alias("c")))
        while True:
            next_ = chain.select(F.col("node").alias("down"), F.col("down").alias("end"), F.col("s").alias("ns"), F.col("c").alias("nc"))
            if not chain.join(next_, "down", "left_semi").limit(1).count():
                break
            s = F.when(F.col("end").isNull(), F.col("s")).otherwise(F.greatest("s", F.col("c") + F.col("ns")))
            c = F.col("c") + F.coalesce("nc", F.lit(0.0))
            chain = written(chain.join(next_, "down", "left").select("node", "parent", F.coalesce("end", "down").alias("down"), s.alias("s"), c.alias("c")))
        late.append(chain.select("node", "down", "s", "c"))
        tops = chain.join(chain.select(F.col("node").alias("parent")), "parent", "left_anti")
        tops = tops.select(F.col("down").alias("node"), F.col("parent").alias("above"), "s", "c", F.lit(True).alias("cut"))
        kept = rest.filter("open <> 1").join(tops, "node", "left")
        step = [F.when(F.col("cut"), F.col(new)).otherwise(F.col(old)).alias(old) for old, new in (("parent", "above"), ("es", "s"), ("ec", "c"))]
        waiting = written(kept.select("node", step[0], "least", "plus", "open", step[1], step[2]))
    known = _union(done)
    for chain in reversed(late):
        ends = known.select(F.col("node").alias("down"), "value")
        found = chain.join(ends, "down").select("node", F.greatest("s", F.col("c") + F.col("value")).alias("value"))
        known = written(known.unionByName(found))
    return known


def _choose(tree: DataFrame, single_root: bool) -> tuple[DataFrame, DataFrame]:
    """(cluster, size, stability) and (cluster, top), the chosen cluster each cluster lies in, if any.

    ``tree`` has cluster, parent, birth, split (density at which it splits, if it does), own and left (number of its own points and sum of
    the densities at which they fall out). From the leaves up, a cluster is worth its own stability or the worth of its two parts, whichever
    is more, and its own on a tie; the topmost ones that are worth their own are chosen. A single root stands for all points
    and is not chosen. Rounds are as many as the logarithm of the number of clusters (``_fold_up``); then pointers to the parents double.
    """
    leaf, never = F.col("split").isNull(), F.lit(_NEVER)
    node = [F.col("cluster").alias("node"), "parent"]
    parts = F.when(leaf, 0).otherwise(2).alias("open")
    sizes = _fold_up(tree.select(*node, never.alias("least"), F.col("own").cast("double").alias("plus"), parts))
    size = F.col("value").cast("long")
    stability = F.col("left") + F.coalesce((size - F.col("own")) * F.col("split"), F.lit(0.0)) - size * F.col("birth")
    sized = tree.join(sizes.withColumnRenamed("node", "cluster"), "cluster")
    sized = written(sized.select("cluster", "parent", "split", size.alias("size"), stability.alias("stability")))
    least, plus = F.when(leaf, never).otherwise(F.col("stability")), F.when(leaf, F.col("stability")).otherwise(0.0)
    worth = _fold_up(sized.select(*node, least.alias("least"), plus.alias("plus"), parts)).withColumnRenamed("node", "cluster")
    below = worth.join(sized.select("cluster", "parent"), "cluster").groupBy(F.col("parent").alias("cluster")).agg(F.sum("value").alias("below"))
    every = written(sized.join(below, "cluster", "left").withColumn("leaf", leaf))
    allowed = (F.col("leaf") | (F.col("stability") >= F.col("below"))) & (F.col("parent").isNotNull() if single_root else F.lit(True))
    paths = written(every.select("cluster", F.col("parent").alias("up"), F.when(allowed, F.col("cluster")).alias("top")))
    while paths.filter("up is not null").limit(1).count():
        above = paths.select(F.col("cluster").alias("up"), F.col("up").alias("next"), F.col("top").alias("higher"))
        paths = written(paths.join(above, "up", "left").select("cluster", F.col("next").alias("up"), F.coalesce("higher", "top").alias("top")))
    return every.select("cluster", "size", "stability"), paths.select("cluster", "top")


def condense(points: DataFrame, edges: DataFrame, min_cluster_size: int = 10) -> DensityHierarchy:
    """Condensed tree of ``points`` (id) over edges (src, dst, reach), and the chosen clusters.

    Cutting the graph at ever smaller distances splits it; a part of fewer than ``min_cluster_size`` points falls out of its cluster, two
    larger parts are clusters of their own. The stability of a cluster is the sum over its points of the density at which the point
    leaves it less the density at which the cluster began. What the graph does not link is apart at any distance.
    """
    if min_cluster_size < 2:
        raise ValueError("a cluster has two points or more")
    a, b = F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    one = edges.filter("src <> dst").groupBy(a, b).agg(F.min(F.col("reach").cast("double")).alias("w"))
    splits, falls, tops = _merge_rounds(points.select("id"), one, min_cluster_size)
    if falls is None:
        nobody = points.select("id", F.lit(None).cast("string").alias("cluster"), F.lit(None).cast("double").alias("fell"), F.lit(NOISE).cast("long").alias("cluster_id"))
        kind = "cluster string, parent string, size long, birth double, stability double, chosen boolean"
        return DensityHierarchy(points.sparkSession.createDataFrame([], kind), nobody)
    splits, density = written(splits), 1 / F.greatest("e.w", F.lit(_TINY))
    places = written(_climb(falls, splits).select("id", "cluster", density.alias("fell")))
    # a cluster is known by its points or by its parts
    own = places.groupBy("cluster").agg(F.count(F.lit(1)).alias("own"), F.sum("fell").alias("left"))
    parted = splits.select(F.col("parent").alias("cluster"), density.alias("split")).distinct()
    tree = own.join(parted, "cluster", "full").join(splits.select("cluster", "parent", density.alias("birth")), "cluster", "left")
    tree = written(tree.fillna(0, ["own"]).fillna(0.0, ["left", "birth"]))
    sums, chosen = _choose(tree, tops.count() == 1)
    chosen = written(chosen)
    held = places.join(chosen, "cluster", "left")
    names = held.filter("top is not null").groupBy("top").agg(F.min("id").alias("cluster_id"))
    labelled = held.join(names, "top", "left").select("id", "cluster", "fell", "cluster_id")
    full = points.select("id").join(labelled, "id", "left")
    full = written(full.select("id", "cluster", "fell", F.coalesce("cluster_id", F.lit(NOISE)).cast("long").alias("cluster_id")))
    picked = chosen.filter("cluster = top").select("cluster", F.lit(True).alias("chosen"))
    tree = tree.select("cluster", "parent", "birth").join(sums, "cluster").join(picked, "cluster", "left")
    return DensityHierarchy(tree.withColumn("chosen", F.coalesce("chosen", F.lit(False))), full)


def density_hierarchy(
    points: DataFrame, min_cluster_size: int = 10, min_points: int | None = None, metric: str = "euclidean", neighbors: int | None = None
) -> DensityHierarchy:
    """Density hierarchy of ``points`` (id, vec) over the mutual reachability of nearest neighbours; no distance has to be chosen.

    ``neighbors`` (``min_points`` if not given) is how many neighbours a point is linked to; with fewer than a cluster has points,
    clusters may be parts of the graph that nothing links.
    """
    edges = written(reachability_edges(points, min_points or min_cluster_size, metric, neighbors))
    return condense(points, edges, min_cluster_size)
