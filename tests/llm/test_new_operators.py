"""Prefix trie, whitening and window dedup against brute force and on odd rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from conceptlink.llm import prefix_trie, whitening, window_dedup
from conceptlink.llm.common import table
from conceptlink.llm.fm_index import FMIndex
from conceptlink.llm.radix import Few, Full, Indexed, RadixTree

# --- prefix trie -----------------------------------------------------------------------


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[conv].append((turn is not None, turn or 0, mark, role, text))
    convs = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in convs.items():
        head = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - int(np.fmod(c, 20)), [])[:head] + v[head:]
    members, below = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for k in range(len(v) + 1):
            members[tuple(v[:k])].append(c)
    for k in members:
        if k:
            below[k[:-1]].append(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in sorted(members, key=len, reverse=True):
        saved[k] += (len(members[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        leaves[k] += not below[k]
        if k:
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))
        up = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), up, len(m), len(below[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURN = "conv_id long, turn long, role string, text string, node string, pos string"


def talks(spark):
    r = np.random.default_rng(3)
    rows = []
    for c in [*range(-25, 65), 400, 10**12]:
        for t in range(int(r.integers(0, 12))):
            said = " ".join(f"w{x}" for x in r.integers(0, 2, int(r.integers(0, 3))))
            rows.append((c, t, "user" if t % 2 else None, said if t else None, "x", "y"))
    rows += [(None, 0, "user", "x", None, None), (7, None, "user", "a  \t b", None, None), (7, None, "user", "a  \t b", None, None)]
    rows += [(600, 5, "user", "same", None, None)] * 3 + [(601, 0, "user", "long " * 50_000, None, None)]
    # a conversation without any turn left, copies, and one much longer than the rest
    rows += [(1003, 0, "user", "only", None, None)]
    rows += [(c, t, "user", f"t{t}", None, None) for c in (2000, 2020, 2040) for t in range(30)]
    return spark.createDataFrame(rows, TURN)


@pytest.mark.parametrize("part,held", [(4096, 1 << 16), (3, 40), (1, 7)])
def test_prefix_trie_equals_brute_force(spark, part, held):
    df = talks(spark)
    got = [tuple(r) for r in prefix_trie.prefix_nodes(df, part, held).collect()]
    want = brute_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(got, key=str) == sorted(want, key=str)


def test_prefix_trie_of_nothing_is_empty(spark):
    assert prefix_trie.prefix_nodes(talks(spark).limit(0)).count() == 0


def test_radix_tree_grows_its_layouts():
    r = np.random.default_rng(1)
    keys = {r.integers(0, 256, int(r.integers(1, 9)), dtype=np.uint8).tobytes() for _ in range(3000)} | {b"", b"same start", b"same", b"same step"}
    tree = RadixTree()
    for k in keys:
        tree.insert(k, k)
    assert isinstance(tree.root.below, Full)
    seen, path, layouts = [], [b""], set()
    for begin, edge, node in tree.walk():
        whole = b"".join(path)[:begin] + edge
        path = [whole]
        assert all(v == whole for v in node.values)
        seen += node.values
        layouts.add(type(node.below))
    assert seen == sorted(keys) and {Few, Full, type(None)} <= layouts
    small = Few()
    for n in range(256):
        small = small.put(n, n)
        assert type(small) is (Few if n < 16 else Indexed if n < 48 else Full)
        assert [small.get(i) for i in range(n + 2) if i < 256] == [*range(n + 1), *([None] if n < 255 else [])]


# --- whitening -------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int, vec string, n int"


def embedded(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(c) for c in v], 0, "x", 1) for i, v in enumerate(x)] + list(extra), VEC)


def check_whitening(out, x, components):
    """Compare with an eigendecomposition of exact covariances."""
    ints = np.floor(64 * np.asarray(x, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(ints), ints.sum(axis=0)
    spread = n * ints.astype(object) - sums
    centred = (spread / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = np.full((n, components), np.nan)
    for r in out:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == int((spread[r["vec_id"]] ** 2).sum())
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-8)
        assert r["identity_error"] < 1e-8
    want = centred @ vectors[:, :components] / np.sqrt(values[:components])
    assert len(out) == n * components
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-7


@pytest.mark.parametrize("n,dim", [(300, 40), (500, 5), (7, 4)])
def test_whitening_equals_an_eigendecomposition(spark, n, dim):
    x = np.random.default_rng(dim).normal(size=(n, dim)) * np.linspace(0.1, 30, dim)
    check_whitening(whitening.whiten(embedded(spark, x)).collect(), x, min(32, dim))


def test_whitening_of_nearly_dependent_columns(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(400, 6))
    x[:, 5] = x[:, 0] * 1000 + r.normal(size=400) / 16
    check_whitening(whitening.whiten(embedded(spark, x)).collect(), x, 6)


def test_whitening_leaves_out_directions_without_variance(spark):
    x = np.random.default_rng(2).normal(size=(60, 5))
    x[:, 3] = 2.5
    x[:, 4] = x[:, 1]
    check_whitening(whitening.whiten(embedded(spark, x)).collect(), x, 3)


def test_whitening_of_odd_rows(spark):
    x = np.random.default_rng(4).normal(size=(50, 3))
    bad = [(900, None, 0, "x", 1), (901, [1.0, None, 2.0], 0, "x", 1), (902, [1.0, float("nan"), 2.0], None, None, None), (903, [float("inf"), 0.0, 0.0], 0, "x", 1), (904, [1.0], 0, "x", 1), (905, [], 0, "x", 1)]
    check_whitening(whitening.whiten(embedded(spark, x, bad)).collect(), x, 3)
    again = [(None, [1.0, 2.0, 3.0], 0, "x", 1), (None, [1.0, 2.0, 3.0], 0, "x", 1)]
    assert whitening.whiten(embedded(spark, x, again)).count() == 52 * 3
    assert whitening.whiten(embedded(spark, x).limit(0)).count() == 0
    assert whitening.whiten(embedded(spark, x[:1])).count() == 0
    assert whitening.whiten(embedded(spark, np.ones((9, 4)))).count() == 0
    wide = whitening.whiten(embedded(spark, np.outer([1, -1, 1e18], [1e18, 1])))
    assert {r["deviation"] for r in wide.collect()} == {None}


def test_triangular_solve_inverts_the_factor():
    r = np.random.default_rng(0)
    upper = np.triu(r.normal(size=(9, 9))) + 9 * np.eye(9)
    rows = r.normal(size=(20, 9))
    assert np.allclose(whitening.solve(rows, upper) @ upper, rows)


# --- window dedup ----------------------------------------------------------------------


@pytest.mark.parametrize("depth", [1, 3, 5, 13])
def test_fm_index_gives_matching_statistics(depth):
    r = np.random.default_rng(depth)
    text = r.integers(0, 4, 300)
    text[-1] = 0
    index = FMIndex(text, depth)
    q, starts, sizes = r.integers(1, 6, 200), np.array([0, 50, 50, 120]), np.array([50, 0, 70, 80])
    length, low, high = index.matching_statistics(q, starts, sizes)
    for s, size in zip(starts, sizes):
        for i in range(s, s + size):
            fits = [0]
            for k in range(1, min(depth, s + size - i) + 1):
                places = [x for x in range(len(text) - k + 1) if (text[x : x + k] == q[i : i + k]).all()]
                if not places:
                    break
                fits = [k, places]
            assert length[i] == fits[0]
            if fits[0]:
                assert sorted(index.suffixes[low[i] : high[i]]) == fits[1]


def brute_windows(rows, span):
    first = {}
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - span + 1):
            if doc is not None:
                k = tuple(w[i : i + span])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w, gone = (text or "").encode().split(), set()
        for i in range(len(w) - span + 1):
            if doc is not None and first[tuple(w[i : i + span])] < doc:
                gone |= set(range(i, i + span))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


DOC = "doc_id long, text string, row string, g long, ranges string"


def pages(spark):
    r = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(40)]
    said = lambda n, m: [f"w{x}" for x in r.integers(0, m, n)]
    texts = [said(60, 10**6) for _ in range(6)]
    texts += [[*said(20, 10**6), *passage, *said(20, 10**6)] for _ in range(40)]
    texts += [texts[3], texts[3], texts[3][:30] + texts[4][20:], said(300, 3), said(300, 3), passage[:13], passage[:12], ["x"] * 500, ["x"] * 12]
    rows = [(i, " ".join(t), "s", i, None) for i, t in enumerate(texts)]
    rows += [(90, "\t\n".join(passage) + "é", "s", 1, None), (None, " ".join(passage), "s", 1, None), (91, None, None, None, None), (92, "", "s", 1, None), (93, " \n", "s", 1, None)]
    # repeated ids: equal rows, other texts, and a passage within one document only
    rows += [(7, " ".join(passage), "s", 1, None)] * 2 + [(94, " ".join([*texts[50], *texts[50]]), "s", 1, None), (94, " ".join(texts[5]), "s", 1, None)]
    rows += [(95, "".join(f"v{i % 9973}   " for i in range(300_000)), "s", 1, None)]
    return spark.createDataFrame(rows, DOC)


@pytest.mark.parametrize("group", [4096, 3])
def test_window_dedup_equals_brute_force(spark, group):
    df = pages(spark).repartition(5)
    out = window_dedup.dedup_windows(df, span=13, group=group).collect()
    got = sorted([tuple(r)[:4] for r in out], key=str)
    assert got == brute_windows([(r["doc_id"], r["text"]) for r in df.collect()], 13)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in out)


def test_window_dedup_in_small_pieces(spark, monkeypatch):
    for name, value in (("_BYTES", 64), ("_PIECE", 32), ("_FOLD", 50), ("_SHARD", 100)):
        monkeypatch.setattr(window_dedup, name, value)
    df = pages(spark).filter("doc_id <> 95")
    texts = [(r["text"] or "").encode() for r in df.collect()]
    words, counts = window_dedup.word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    flat = [w for t in texts for w in t.split()]
    assert len(set(flat)) == len(set(words.tolist())) == len(set(zip(flat, words.tolist())))


def test_window_dedup_of_nothing_is_empty(spark):
    assert window_dedup.dedup_windows(pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_window_dedup_on_given_documents(spark, tiny, name):
    df = table(spark, tiny, name)
    got = sorted([tuple(r)[:4] for r in window_dedup.dedup_windows(df).collect()], key=str)
    assert got == brute_windows([(r["doc_id"], r["text"]) for r in df.collect()], 13)
