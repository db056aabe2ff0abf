"""Operators of conceptlink.llm against brute force, round trips and odd rows."""

import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.llm import chat, decontaminate, embedding_dedup, line_dedup, ngram_join, packing, pii, quality, suffix_dedup, warc
from conceptlink.llm.queries import tokenizer_path

DOC = "doc_id long, text string, source string, n long"
ODD = [(None, "x", None, 1), (900, None, "s", None), (901, "", None, 1), (902, "  \n\t", "s", 2)]


def frame(spark, texts, odd=True):
    return spark.createDataFrame([(i, t, "s", i) for i, t in enumerate(texts)] + (ODD if odd else []), DOC)


def words(seed, n):
    r = np.random.default_rng(seed)
    return [f"w{x}" for x in r.integers(0, 10**6, n)]


def test_line_dedup_keeps_the_last_holder(spark):
    line = "A line of more than twenty letters"
    docs = frame(spark, [f"{line}\na", f" {line.upper()} \nb\nb", f"c\n{line}", "short\nshort", "short"])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0] == ("a", 2, 1) and got[1] == ("b\nb", 3, 1) and got[2] == (f"c\n{line}", 2, 0)
    assert got[3] == ("short\nshort", 2, 0) and got[900] == ("", 1, 0) and got[None] == ("x", 1, 0)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_with_clashing_columns(spark):
    line = "A line of more than twenty letters"
    kind = "doc_id long, text string, id long, mark string, drop array<int>, found string, pos int, n_lines string, `a.b` int, doc string"
    rows = [(i, f"{line}\nx{i}", 9, "m", [1], "f", 2, "own", 3, None) for i in range(4)] + [(None, line, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, kind)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert {i: r["text"] for i, r in got.items()} == {0: "x0", 1: "x1", 2: "x2", 3: f"{line}\nx3", None: line}
    assert got[0]["n_lines"] == 2 and got[0]["n_dropped"] == 1 and got[0]["id"] == 9 and got[0]["drop"] == [1] and got[0]["a.b"] == 3
    plain = line_dedup.dedup_lines(docs, counts=False)
    assert plain.columns == docs.columns and {r["n_lines"] for r in plain.collect()} == {"own", None}


def test_line_dedup_of_a_very_long_document(spark):
    r = np.random.default_rng(4)
    shared = [f"a shared line with number {i}" for i in range(60_000)]
    own = [f"an own line with number {i} of its own" for i in range(60_000)]
    mixed = [x for pair in zip(shared, own) for x in pair] + ["", "short"]
    texts = ["\n".join(r.permutation(shared)), "\n".join(mixed), "\n".join(shared)]
    got = {x["doc_id"]: x for x in line_dedup.dedup_lines(frame(spark, texts, False)).collect()}
    assert got[0]["text"] == "" and got[0]["n_dropped"] == 60_000 and got[2]["text"] == texts[2]
    assert got[1]["text"] == "\n".join([*own, "", "short"]) and got[1]["n_lines"] == 120_002


def test_suffix_dedup_equals_brute_force(spark):
    r = np.random.default_rng(1)
    parts = ["".join(r.choice(list("abcde é"), n)) for n in (150, 220, 130, 99, 100)]
    texts = [parts[0] + "x" + parts[1], parts[1] + parts[2], "q" + parts[0] + parts[0], "z" * 400, parts[4] + parts[3], parts[4], parts[0] + "x" + parts[1]]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in suffix_dedup.dedup_substrings(frame(spark, texts, False)).collect()}
    seen = set()
    for i, t in enumerate(texts):
        b, gone = t.encode(), set()
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone |= set(range(p, p + 100))
            seen.add(b[p : p + 100])
        spans = sum(1 for p in gone if p - 1 not in gone)
        assert got[i] == (len(b), len(gone), spans, bytes(x for p, x in enumerate(b) if p not in gone))
    repeated = frame(spark, ["a" * 150] * 2).unionByName(spark.createDataFrame([(1, "b" * 150, "s", 1), (1, "b" * 150, "s", 1)], DOC))
    assert suffix_dedup.dedup_substrings(repeated).count() == 8


def test_merge_sort_orders_suffixes():
    buf = np.frombuffer(b"banana bandana banana" * 3, np.uint8)
    h = suffix_dedup.PrefixHashes(buf)
    start = np.arange(len(buf) - 10)
    group = (start >= 20).astype(int)
    got = suffix_dedup.merge_sort(h, start, group, 10).tolist()
    raw = buf.tobytes()
    for part in (range(20), range(20, len(start))):
        assert [x for x in got if x in part] == sorted(part, key=lambda p: (raw[p : p + 10], p))


def test_ngram_join_links_chains_and_leaves_others(spark):
    base = words(1, 200)
    near = [*base[:195], *words(2, 5)]
    far = [*near[:190], *words(3, 10)]
    texts = [" ".join(base), " ".join(near), " ".join(far), " ".join(words(4, 200)), "one two", "One  TWO", " ".join(base).upper()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(frame(spark, texts), 4, 85).collect()}
    sets = [{tuple(t.lower().split()[i : i + 4]) for i in range(max(1, len(t.split()) - 3))} for t in texts]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 85 * len(x | y):
                root = [min(root[i], root[j]) if k in (root[i], root[j]) else k for k in root]
    assert {i: got[i] for i in range(len(texts))} == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert got[900] == (0, 900) and got[902] == (0, 902) and got[None][1] is None


def test_pair_signatures_find_sets_of_frequent_shingles():
    r = np.random.default_rng(5)
    frequent = np.ones(1 << ngram_join.SKETCH_BITS, bool)
    for n in (7, 20, 100, 700):
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        keep = -(-len(x) * 92 // 100)
        y = np.unique(np.concatenate([r.permutation(x)[:keep], r.integers(0, 2**63, len(x) - keep).astype(np.uint64)]))
        if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)):
            assert np.intersect1d(ngram_join.signatures(x, frequent, 85)[0], ngram_join.signatures(y, frequent, 85)[0]).size


@pytest.mark.parametrize("percent,least_gap", [(85, 6), (80, 4), (90, 9)])
def test_signatures_meet_in_the_smallest_sets_that_link(percent, least_gap):
    r = np.random.default_rng(7)
    tried = set()
    for n in range(1, 16):
        for m in (m for m in range(n + 1, 20) if 100 * n >= percent * m):
            for share in (0, 0.2, 0.5, 0.8, 1):
                y = np.unique(r.integers(0, 2**63, m).astype(np.uint64))
                x = r.permutation(y)[:n]
                frequent = np.zeros(1 << ngram_join.SKETCH_BITS, bool)
                frequent[ngram_join._bucket(y[r.random(m) < share])] = True
                (a, f), (b, g) = (ngram_join.signatures(s, frequent, percent) for s in (x, y))
                common = np.intersect1d(a, b)
                assert common.size and int((common & np.uint64(1) == 0).sum()) >= ngram_join.needed(n, m, f, g, percent)
            tried.add(n)
    assert min(tried) == least_gap


@pytest.mark.parametrize("shingle,percent,n", [(4, 85, 9), (5, 80, 8)])
def test_ngram_join_links_a_short_text_with_one_word_added(spark, shingle, percent, n):
    base = words(30, n)
    texts = [" ".join(base), " ".join([*base, "end"]), " ".join(base[:-1]), " ".join(["start", *words(31, n)]), " ".join(words(31, n))]
    # enough texts that the shingles of the next pair are frequent
    often = [f"o{i}" for i in range(n)]
    texts += [" ".join(often), " ".join([*often, "end"])] + [" ".join([*often, *words(40 + i, 60)]) for i in range(80)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(frame(spark, texts), shingle, percent).collect()}
    assert [got[i] for i in range(7)] == [0, 0, 2, 3, 3, 5, 5]


def test_parities_never_rule_out_a_true_overlap():
    r = np.random.default_rng(6)
    for n, m, both in ((1, 1, 1), (50, 60, 40), (3000, 2500, 2400), (200, 200, 0)):
        x = r.integers(0, 2**63, n + m - both).astype(np.uint64)
        a, b = (np.frombuffer(ngram_join.parities(s), np.uint64) for s in (x[:n], x[n - both :]))
        assert int(np.bitwise_count(a ^ b).sum()) <= n + m - 2 * both


def test_ngram_join_of_a_loose_group_equals_brute_force(spark):
    # edits of one text that lie just above and just below the threshold of each other
    base, r = words(20, 120), np.random.default_rng(20)
    texts = [" ".join(w if x > 0.03 else f"e{i}x{j}" for j, (w, x) in enumerate(zip(base, r.random(120)))) for i in range(90)]
    got = {x["doc_id"]: x["component_id"] for x in ngram_join.similar_groups(frame(spark, texts), 5, 80).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                root = [min(root[i], root[j]) if k in (root[i], root[j]) else k for k in root]
    assert 1 < len(set(root)) < len(texts) and [got[i] for i in range(len(texts))] == root


def test_ngram_join_with_repeated_ids_nulls_and_clashing_columns(spark):
    one, other = ([f"{c}{i}" for i in range(60)] for c in "wz")
    texts = [" ".join(t) for t in (one, other, [*one[:59], "x"], [*other[:59], "y"])]
    rows = [(1, texts[0], "c", 1), (1, texts[1], "c", 2), (2, texts[2], None, 3), (3, texts[3], "c", 4), (None, texts[0], "c", 5), (4, None, "c", 6), (4, "", "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, bits int")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(docs, 5, 80).collect())
    assert got == [("1", 56, 1), ("1", 56, 1), ("2", 56, 1), ("3", 56, 1), ("4", 0, 4), ("4", 0, 4), ("None", 56, None)]
    assert ngram_join.similar_groups(docs.limit(0), 5, 80).count() == 0


def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    texts = [" ".join(words(i, 60 * i)) + " été　<|endoftext|> it's" for i in range(12)]
    rows = packing.pack_documents(frame(spark, texts), tokenizer_path(), 256).collect()
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == 256 for r in own[1:])
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled.get(r["sequence_id"], 0) == r["offset"]
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 256
    assert packing.pack_documents(frame(spark, [], False), tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", [" " * 1_200_000, "a" + "\n" * 1_200_000 + "b", " " * 100_000, "\t" * 99_999 + "x", "a" * 1_200_000, "#" * 1_200_000, "1" * 1_200_000, " a" * 600_000, "x " + "\u2003\n " * 700 + "é", "b" + " " * 1000, " " * 1001 + "'s", "\r\n" * 2500 + "7", "\x1c" * 1500 + "a", " \x1c" * 900, " " * 1200 + "\x1c"])
def test_long_runs_get_the_ids_of_tokenizers(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    assert packing.token_ids(tokenizer_path(), text) == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("form", ["{}", "{} a", "a {}", "a{}b {} c", "{}{}", " {}  {}\n", "x" + " " * 1500 + "{}" + " " * 1500, "<|end{}oftext|>", "{}'s"])
def test_names_of_added_tokens_get_the_ids_of_tokenizers(form):
    from tokenizers import Tokenizer

    tok, text = Tokenizer.from_file(tokenizer_path()), form.replace("{}", "<|endoftext|>")
    ids = packing.token_ids(tokenizer_path(), text)
    assert ids == tok.encode(text, add_special_tokens=False).ids and 50256 in ids


def test_quick_encoder_merges_as_tokenizers():
    from tokenizers import Tokenizer

    # then both reach the same pieces in any text: a pair that makes an entry is always that entry's own merge
    with open(tokenizer_path(), encoding="utf-8") as f:
        model = json.load(f)
    vocab = model["model"]["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
    assert made == sorted(set(made)) and model["normalizer"] is None
    tok = Tokenizer.from_file(tokenizer_path())
    special = {t["content"] for t in model["added_tokens"]}
    assert all([x.id for x in tok.model.tokenize(w)] == [i] for w, i in vocab.items() if w not in special)
    for c in range(0, 0x3000, 16):
        text = "".join(f"a{chr(x)}1 {chr(x)}{chr(x)}!{chr(x)} b" for x in range(c, c + 16))
        assert packing.token_ids(tokenizer_path(), text) == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("counts,bins", [({6: 2, 4: 2, 5: 2}, 3), ({10: 3}, 3), ({7: 1, 3: 1, 2: 1, 1: 1}, 2), ({5: 3}, 2)])
def test_pack_sizes(counts, bins):
    found = packing.pack_sizes(counts, 10)
    assert sum(m for m, _ in found) == bins
    assert {s: sum(m * c.count(s) for m, c in found) for s in counts} == counts


def test_leaks_allow_substitutions_and_spare_clean_texts(spark):
    item = words(7, 40)
    changed = [w if i % 6 else "zz" for i, w in enumerate(item)]
    texts = [" ".join([*words(8, 30), *item, *words(9, 10)]), " ".join([*words(10, 5), *changed]), " ".join(words(11, 300)), " ".join(item[:12])]
    bench = spark.createDataFrame([(1, " ".join(item), "u"), (2, "a b", "u"), (None, None, "u"), (3, " ".join(words(12, 6)), "u")], "item_id long, text string, doc_id string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame(spark, texts), bench).collect()} == {(0, 1), (1, 1)}
    assert decontaminate.leaks(frame(spark, texts), bench.limit(0)).count() == 0
    assert decontaminate.leaks(frame(spark, texts).limit(0), bench).count() == 0


def plain_leaks(docs, items, percent=80):
    """doc_id, item_id -> (equal words of the best window, its first place), window by window."""
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    out = {}
    for doc, text in docs:
        d = split(text)
        for item_id, item in items:
            q = split(item)
            n = min(len(q), 16)
            need = percent * n if n >= 5 else 100 * n
            for i in range(len(q) - n + 1 if n else 0):
                for j in range(len(d) - n + 1):
                    same = sum(x == y for x, y in zip(q[i : i + n], d[j : j + n]))
                    if 100 * same >= need:
                        out[doc, item_id] = max(out.get((doc, item_id), (0, 0)), (same, -j))
    return {k: (n, -j) for k, (n, j) in out.items()}


@pytest.mark.parametrize("hot", [20_000, 2])
def test_leaks_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(decontaminate, "_HOT", hot)
    r = np.random.default_rng(21)
    few = lambda n: [f"W{x}" for x in r.integers(0, 12, n)]  # few words, so that seeds are shared everywhere
    items = [(i, few(n)) for i, n in enumerate([1, 2, 3, 4, 4, 5, 6, 9, 15, 16, 17, 30, 120])] + [(40, words(3, 300)), (41, [])]
    docs = [few(80) for _ in range(6)] + [words(3, 300)] * 3
    for _, q in items:
        for share in (0.1, 0.25):
            docs.append(few(3) + [w.lower() if r.random() > share else "zz" for w in q] + few(2))
    docs += [items[12][1] * 2, ["y"] * 400 + items[9][1] + ["y"] * 400]
    rows = [(i, "\t ".join(d)) for i, d in enumerate(docs)]
    bench = [(i, " ".join(q)) for i, q in items]
    got = decontaminate.leaks(frame(spark, [t for _, t in rows] + [rows[7][1]]), spark.createDataFrame(bench + bench[:3] + [(None, None)], "item_id long, text string"))
    expected = plain_leaks(rows + [(len(rows), rows[7][1])], bench)
    assert {(x["doc_id"], x["item_id"]): (x["n_equal"], x["first_word"]) for x in got.collect()} == expected


def test_short_items_can_be_passed_over(spark):
    bench = spark.createDataFrame([(1, "A b"), (2, "c d e f g")], "item_id long, text string")
    docs = frame(spark, ["x a B y", "a c d e f g", "ab a  c b"])
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == {(0, 1), (1, 2)}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, least=5).collect()} == {(1, 2)}


def test_base_spans():
    text = "a@b.c_x@d.ef, 1.2.3.4.5 256.1.1.1 +1 (555) 123-4567, 4111 1111 1111 1111 é x@y"
    found = [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)]
    assert found == [("email", "a@b.c"), ("email", "_x@d.ef"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]
    assert pii.base_spans("1" * 200_000 + "a" * 200_000) == []


def test_report_counts_each_kind_and_digests_the_base_spans(spark):
    texts = ["a@b.cc", "a@b.cc, c@d.ee 1.2.3.4 +1 555 123 4567", "4111 1111 1111 1111", "+1 555 123 4567, 1.2.3.4 5.6.7.8", "none"]
    rows = {r["doc_id"]: r for r in pii.span_report(pii.find_personal_data(frame(spark, texts))).collect()}
    for i, text in enumerate(texts):
        spans = pii.base_spans(text)
        assert [rows[i][f"n_{name}"] for name in pii.KINDS] == [sum(k == n for k, _, _ in spans) for n in range(4)]
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert [tuple(rows[i][f"n_{name}"] for name in pii.KINDS) for i in range(5)] == [(1, 0, 0, 0), (2, 1, 0, 1), (0, 0, 1, 0), (0, 2, 0, 1), (0, 0, 0, 0)]


def test_learned_context_finds_what_no_pattern_does(spark):
    texts = [f"please call me+{i}@mail.example.com today" for i in range(4)] + ["please call me(at)mail today", "see item no 12345678 there"]
    rows = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(frame(spark, texts)).collect()}
    assert [(s["kind"], texts[4][s["low"] : s["high"]]) for s in rows[4]] == [(0, "me(at)mail")]
    assert rows[5] == [] and rows[900] == [] and len(rows[0]) == 1


def learned(spark, texts):
    """Text number -> kind and text of its learned spans."""
    rows = pii.find_personal_data(frame(spark, texts)).filter("doc_id < 900").collect()
    return {r["doc_id"]: [(pii.KINDS[x["kind"]], texts[r["doc_id"]][x["low"] : x["high"]]) for x in r["spans"] if x not in r["base"]] for r in rows}


def test_learned_contexts_find_identifiers_with_blanks(spark):
    texts = [f"Ring us on +1 555 010 {1000 + i} now" for i in range(12)] + [f"mail her at: x{i}@host.org , thanks" for i in range(12)]
    more = ["Ring us on 555 123 4567 now", "Ring us on (555) 123-4567 now", "lot 555 123 4567 sold", "mail her at: Ann.B at host dot org , thanks", "mail her at: bob [at] mail (dot) host.net , thanks"]
    got = learned(spark, texts + more)
    assert [got[24 + i] for i in range(5)] == [[("phone", "555 123 4567")], [("phone", "(555) 123-4567")], [], [("email", "Ann.B at host dot org")], [("email", "bob [at] mail (dot) host.net")]]
    assert not any(got[i] for i in range(24))


def test_patterns_chain_until_none_is_new(spark):
    # the two last instances of a context are known to the next one, which is accepted only when they are scored
    texts = []
    for n in range(6):
        known = [f"+1 555 01{n} {1000 + i}" for i in range(10)]
        unknown = [f"555 {m}7 400{i}" for m in (n, n + 1) if m for i in range(2)]
        texts += [f"step{n} of{n} {x} more{n}" for x in known + unknown]
    got = learned(spark, texts)
    unseen = [i for i, t in enumerate(texts) if "+1" not in t]
    assert len(unseen) == 22 and all(got[i] == [("phone", texts[i][10:-6])] for i in unseen)
    assert not any(got[i] for i in set(got) - set(unseen))


def test_candidates_of_long_and_odd_texts():
    assert pii._candidates("1" * 200_000 + " (" * 50_000 + "1 " * 50_000, []) == [(0, 200_000)]
    assert pii._candidates("a at " * 40_000, []) == [] and pii._candidates("", []) == []
    text = "x" * 100_000 + " 555 123 4567 " + "y" * 100_000
    assert pii._candidates(text, []) == [(100_001, 100_013)] and len(pii._contexts(text, 100_001, 100_013)) == 1
    assert pii._candidates("call 12 34, or (call 555 1234)", []) == [(21, 29)]


def test_warc_reads_past_magic_in_payloads(spark, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    html = ["<p>one</p>", f"x{fake}y", "<p>one</p>", None, "", "WARC/1.1\r\n" * 3, "é" * 500]
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\nX: 1", h, "e") for i, h in enumerate(html)] + [(None, None, "lone", "e")], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    got = {r["page_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert len(got) == len(html) + 1 and all(r["verified"] for r in got.values())
    last = {h or "": i for i, h in enumerate(html)}
    for i, h in enumerate(html):
        first = last[h or ""]
        r = got[i]
        assert r["payload_bytes"] == len((h or "").encode()) and r["payload_digest"] == warc._digest((h or "").encode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))


def test_near_vectors(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=16)
    vecs = [base, base + 0.01 * r.normal(size=16), base, r.normal(size=16), np.zeros(16), [*base[:15], float("nan")], None, [None] * 16]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "t") for i, v in enumerate(vecs)] + [(20, base.tolist(), None, "t"), (21, base.tolist(), 2, "t"), (None, base.tolist(), 1, "t")]
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, t string")).collect()}
    assert got[0] == (2, 0, True) and got[1] == (2, 0, False) and got[2] == (2, 0, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 20, 21)) and got[None] == (0, None, False)


def test_chat_round_trip_and_best_branch(spark):
    odd = [("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", "a<\\|b<|"), ("ro\nle\\", "\n<|"), ("assistant", "")]
    text, mask = chat.format_turns(odd)
    assert chat.parse_turns(text) == odd
    assert [chat.unescape(text[a:b]) for a, b in mask] == ["a<\\|b<|", ""]
    rows = [(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 1.0, "assistant", "bad"), (1, 3, 1, 5.0, "assistant", "good"), (1, 4, 3, 5.0, "user", None), (2, 9, 99, None, None, "alone")]
    tree = spark.createDataFrame(rows, "conv_id long, node long, parent long, score double, role string, text string")
    got = {r["conv_id"]: chat.parse_turns(r["transcript"]) for r in chat.format_conversations(tree).collect()}
    assert got == {1: [("user", "q"), ("assistant", "good"), ("user", "")], 2: [("", "alone")]}


def test_quality_network_learns_and_scores_any_text(spark):
    good = [" ".join(w for w in words(i, 40)) for i in range(60)]
    bad = [" ".join(f"{w}###" for w in words(100 + i, 40)) for i in range(60)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0, "x") for i in range(120)], "doc_id long, quality int, toxic int, text string")
    net = quality.train(docs, labels, per_class=40)
    rows = {r["doc_id"]: r for r in quality.score_documents(docs, net).collect()}
    held = [rows[i] for i in range(120) if rows[i]["held_out"]]
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(120))
    assert held and np.mean([r["predicted"] == int(r["doc_id"] < 60) for r in held]) >= 0.9
    assert 0 <= rows[900]["score"] <= 1 and rows[900]["score"] == rows[901]["score"]
    assert quality.filter_documents(docs, net).columns == docs.columns
    assert 0 <= net.score(b"ab" * 100_000) <= 1
