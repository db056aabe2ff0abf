"""Average linkage and the density hierarchy against one-by-one clustering in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators import hierarchy, linkage
from conceptlink.operators.density import reachability_edges
from conceptlink.operators.neighbors import nearest
from conceptlink.operators.staging import written


def cloud(spark, n, centers=4, spread=0.6, dim=3, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) * spread + r.integers(0, 2, (centers, dim))[np.arange(n) % centers] * 4
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, vec array<double>")


def greedy_average(ids, edges, k):
    """Merge the two clusters with the shortest mean edge until ``k`` are left."""
    table = {(min(a, b), max(a, b)): (d, 1) for a, b, d in edges}
    label = {i: i for i in ids}
    while table and len(set(label.values())) > k:
        a, b = min(table, key=lambda e: (table[e][0] / table[e][1], e))
        label = {i: a if c == b else c for i, c in label.items()}
        new = {}
        for (x, y), (s, n) in table.items():
            x, y = sorted((a if x == b else x, a if y == b else y))
            if x != y:
                t, m = new.get((x, y), (0.0, 0))
                new[x, y] = (t + s, m + n)
        table = new
    return label


@pytest.mark.parametrize("k,neighbors", [(1, 8), (4, 30), (25, 8)])
def test_average_linkage_equals_one_by_one_merging(spark, k, neighbors):
    points = cloud(spark, 200)
    near = written(nearest(points, neighbors))
    merges = written(linkage.average_linkage(near))
    got = {r["id"]: r["cluster_id"] for r in linkage.cut_linkage(points, merges, k).collect()}
    assert got == greedy_average(range(200), [tuple(r)[:3] for r in near.collect()], k)


def test_average_linkage_on_a_complete_graph_is_the_mean_over_all_pairs(spark):
    x = np.random.default_rng(3).normal(size=(40, 2))
    d = np.linalg.norm(x[:, None] - x, axis=2)
    edges = spark.createDataFrame([(i, j, float(d[i, j])) for i in range(40) for j in range(40)], "src long, dst long, distance double")
    points = spark.range(40)
    parts = [[i] for i in range(40)]
    while len(parts) > 5:
        i, j = min(((i, j) for i in range(len(parts)) for j in range(i)), key=lambda p: d[np.ix_(parts[p[0]], parts[p[1]])].mean())
        parts[j] = sorted(parts[j] + parts.pop(i))
    got = {r["id"]: r["cluster_id"] for r in linkage.cut_linkage(points, linkage.average_linkage(edges), 5).collect()}
    assert got == {i: p[0] for p in parts for i in p}


def test_average_linkage_keeps_unlinked_parts_apart(spark):
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0), (2, 3, 2.0), (3, 3, 0.0)], "src long, dst long, distance double")
    got = {r["id"]: r["cluster_id"] for r in linkage.cut_linkage(spark.range(6), linkage.average_linkage(edges), 1).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5}
    assert linkage.average_linkage(edges.limit(0)).count() == 0


def test_average_linkage_by_blocks_equals_one_by_one_merging(spark, monkeypatch):
    monkeypatch.setattr(linkage, "BLOCK", 200)
    points = cloud(spark, 120)
    near = written(nearest(points, 8))
    merges = written(linkage.average_linkage(near))
    assert merges.count() == merges.select("b").distinct().count()
    for k in (1, 30):
        got = {r["id"]: r["cluster_id"] for r in linkage.cut_linkage(points, merges, k).collect()}
        assert got == greedy_average(range(120), [tuple(r)[:3] for r in near.collect()], k)


def test_average_linkage_of_copies_takes_no_round_for_each(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(linkage, "written", lambda df: tables.append(1) or written(df))
    # copies link to the lowest ids, and all are nearest to the first
    edges = [(i, j, 0.0) for i in range(60) for j in range(4) if i != j] + [(i, 60, 2.0) for i in range(4)]
    for block in (1 << 19, 100):
        monkeypatch.setattr(linkage, "BLOCK", block)
        merges = linkage.average_linkage(spark.createDataFrame(edges, "src long, dst long, distance double")).collect()
        assert sorted(map(tuple, merges)) == [(0, i, 0.0 if i < 60 else 2.0) for i in range(1, 61)]
    assert len(tables) < 60


def brute_hierarchy(ids, edges, m):
    """Condensed tree by merging one edge after another, and the chosen clusters from the top down."""
    table = {}
    for a, b, w in edges:
        key = (min(a, b), max(a, b))
        table[key] = min(w, table.get(key, np.inf))
    root = {i: i for i in ids}
    group = {i: [i] for i in ids}
    cond, stable, parent, home, kids = {}, {}, {}, {}, {}
    for (a, b), w in sorted(table.items(), key=lambda e: (e[1], e[0])):
        x, y = root[a], root[b]
        if x == y:
            continue
        lam = 1 / max(w, 1e-9)
        large = [len(group[x]) >= m, len(group[y]) >= m]
        both = group[x] + group[y]
        if all(large) or (not any(large) and len(both) >= m):
            stable[a, b] = len(both) * lam
            if all(large):
                kids[a, b] = (cond[x], cond[y])
                for z in (x, y):
                    parent[cond[z]] = (a, b)
                    stable[cond[z]] -= len(group[z]) * lam
            else:
                home.update({i: ((a, b), lam) for i in both})
            new = (a, b)
        elif any(large):
            new, out = (cond[x], group[y]) if large[0] else (cond[y], group[x])
            stable[new] += len(out) * lam
            home.update({i: (new, lam) for i in out})
        else:
            new = None
        group[x] = both
        for i in group.pop(y):
            root[i] = x
        cond[x] = new
    tops = [c for c in stable if c not in parent]

    def worth(c):
        return max(stable[c], sum(map(worth, kids[c]))) if c in kids else stable[c]

    chosen, queue = set(), [k for c in tops for k in kids.get(c, ())] if len(tops) == 1 else tops
    while queue:
        c = queue.pop()
        if c not in kids or stable[c] >= sum(map(worth, kids[c])):
            chosen.add(c)
        else:
            queue += kids[c]
    label = {}
    for i in ids:
        c = home.get(i, (None,))[0]
        while c is not None and c not in chosen:
            c = parent.get(c)
        label[i] = c
    names = {c: min(i for i in ids if label[i] == c) for c in chosen}
    return stable, parent, chosen, home, {i: names.get(c, -1) for i, c in label.items()}


def pair(c):
    return None if c is None else (c["a"], c["b"])


@pytest.mark.parametrize("n,m,k,seed", [(300, 8, 5, 1), (120, 3, 3, 2)])
def test_density_hierarchy_equals_one_by_one_merging(spark, n, m, k, seed):
    points = cloud(spark, n, centers=6, spread=0.9, seed=seed)
    edges = written(reachability_edges(points, k))
    found = hierarchy.condense(points, edges, m)
    stable, parent, chosen, home, labels = brute_hierarchy(range(n), [tuple(r) for r in edges.collect()], m)
    tree = {pair(r["cluster"]): r for r in found.tree.collect()}
    assert set(tree) == set(stable) and len(stable) > 2
    for c, r in tree.items():
        assert pair(r["parent"]) == parent.get(c) and r["stability"] == pytest.approx(stable[c], rel=1e-9, abs=1e-9)
        assert r["chosen"] == (c in chosen)
    rows = found.members.collect()
    assert {r["id"]: r["cluster_id"] for r in rows} == labels and len(rows) == n
    for r in rows:
        want, lam = home.get(r["id"], (None, None))
        assert pair(r["cluster"]) == want and (r["fell"] == pytest.approx(lam) if want else r["fell"] is None)


def test_density_hierarchy_finds_dense_groups_and_noise(spark):
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(size=(60, 2)) * 0.2 + c for c in ((0, 0), (6, 0), (0, 6))] + [r.uniform(-20, 20, (15, 2))])
    points = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, vec array<double>")
    labels = {r["id"]: r["cluster_id"] for r in hierarchy.density_hierarchy(points, 12, 5, neighbors=80).labels().collect()}
    groups = [{labels[i] for i in range(s, s + 60)} - {-1} for s in (0, 60, 120)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    assert sum(labels[i] == -1 for i in range(180, 195)) >= 10


def test_density_hierarchy_without_clusters(spark):
    points = spark.range(5)
    none = spark.createDataFrame([], "src long, dst long, reach double")
    assert {r["cluster_id"] for r in hierarchy.condense(points, none, 2).labels().collect()} == {-1}
    chain = spark.createDataFrame([(0, 1, 1.0), (1, 2, 2.0), (2, 3, 3.0)], "src long, dst long, reach double")
    # one cluster holds everything that is linked, so none is chosen
    found = hierarchy.condense(points, chain, 2)
    assert {r["cluster_id"] for r in found.labels().collect()} == {-1} and found.tree.count() == 1
    copies = chain.withColumn("reach", F.lit(0.0)).unionByName(spark.createDataFrame([(3, 4, 9.0)], chain.schema))
    assert hierarchy.condense(points, copies, 2).tree.count() == 1
    with pytest.raises(ValueError):
        hierarchy.condense(points, chain, 1)


def test_a_deep_tree_is_folded_in_few_rounds(spark, monkeypatch):
    # a chain of 300 nodes with a leaf at each, and a second tree that is bushy
    rng = np.random.default_rng(5)
    rows = [(f"n{i}", f"n{i - 1}" if i else None, float(rng.random() * i), 0.0, 2) for i in range(300)]
    rows += [(f"l{i}", f"n{i}", float("-inf"), float(rng.random()), 0) for i in range(300)] + [("z", "n299", float("-inf"), 0.5, 0)]
    rows += [(f"b{i}", f"b{(i - 1) // 2}" if i else None, float(rng.random() * 3) if i < 15 else float("-inf"), float(i >= 15), 2 if i < 15 else 0) for i in range(31)]
    want, parts = {}, {}
    for node, parent, least, plus, _ in sorted(rows, key=lambda r: -int(r[0][1:] or 0) - 1000 * (r[0][0] in "lz")):
        want[node] = max(least, plus + sum(parts.get(node, [])))
        parts.setdefault(parent, []).append(want[node])
    tables = []
    monkeypatch.setattr(hierarchy, "written", lambda df: tables.append(1) or written(df))
    got = hierarchy._fold_up(spark.createDataFrame(rows, "node string, parent string, least double, plus double, open int").coalesce(1))
    assert {r["node"]: pytest.approx(r["value"]) for r in got.collect()} == want
    assert len(tables) < 60
