from pyspark.sql import functions as F

from conceptlink.functions import text as tx
from conceptlink.functions.stemming import stem
from conceptlink.operators import corpus


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


def test_tokens_split_words_numbers_and_marks(spark):
    assert one(spark, "You don't owe $15!", tx.tokens) == ["You", "don", "'", "t", "owe", "$", "15", "!"]
    assert one(spark, "", tx.tokens) == []


def test_clean_tokens_keep_capitalised_stop_words(spark):
    text = "The cat and the dog, right?!"
    assert one(spark, text, tx.clean_tokens) == ["The", "cat", "dog", "right"]
    assert one(spark, text, lambda c: tx.clean_tokens(c, lowercase=True)) == ["cat", "dog", "right"]
    assert one(spark, ["The", "cat"], lambda c: tx.without_stopwords(c, True), "array<string>") == ["cat"]


def test_punctuation_is_a_substring_test(spark):
    # "()" is a piece of the punctuation list, ")(" is not
    assert one(spark, ["()", ")(", "a", "!"], tx.without_punctuation, "array<string>") == [")(", "a"]


def test_corpus_tokens(spark):
    assert one(spark, "Who, me!? I-think 42 so; ☀ yes.", tx.corpus_tokens) == [
        "who", ".", "me", ".", "i", ".", "think", "so", ".", "☀", "yes", "."
    ]


def test_parse_list(spark):
    cases = [("['a', 'b c']", ["a", "b c"]), ('["it\'s"]', ["it's"]), ("[]", []), ("('t','u')", None), ("bad", None), (None, None)]
    for literal, want in cases:
        assert one(spark, literal, tx.parse_list) == want
    assert one(spark, ["a", "b"], tx.list_literal, "array<string>") == "['a', 'b']"


def test_capitalized_and_counted(spark):
    assert one(spark, "éCOLE", tx.capitalized) == "École"
    assert one(spark, "ßa", tx.capitalized) == "Ssa"
    assert one(spark, "", tx.capitalized) == ""
    assert one(spark, None, tx.capitalized) is None
    got = one(spark, ["b", "a", "b", "c", "b"], tx.counted, "array<string>")
    assert [(r["token"], r["n"]) for r in got] == [("a", 1), ("b", 3), ("c", 1)]
    assert one(spark, [], tx.counted, "array<string>") == []


def test_strip_accents(spark):
    df = spark.createDataFrame([("Crème-Brûlée",), ("ﬁn",), ("Straße",), (None,)], "w string")
    rows = {r["w"]: r["f"] for r in tx.strip_accents(df, "w", "f").collect()}
    assert rows == {"Crème-Brûlée": "cremebrulee", "ﬁn": "fin", "Straße": "strae", None: None}


def test_porter_stems(spark):
    # Examples of the published algorithm.
    examples = """caresses:caress ponies:poni ties:tie cats:cat feed:feed agreed:agre plastered:plaster bled:bled
    motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall
    hissing:hiss fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit
    rational:ration valenci:valenc digitizer:digit radicalli:radic differentli:differ vileli:vile operator:oper
    feudalism:feudal decisiveness:decis hopefulness:hope formaliti:formal sensitiviti:sensit triplicate:triplic
    formative:form formalize:formal electrical:electr hopeful:hope goodness:good revival:reviv allowance:allow
    inference:infer airliner:airlin adjustable:adjust irritant:irrit replacement:replac adjustment:adjust
    adoption:adopt communism:commun activate:activ effective:effect probate:probat rate:rate cease:ceas
    controll:control roll:roll enjoy:enjoy dies:die died:die by:by say:say dying:die news:news Running:run"""
    pairs = [tuple(p.split(":")) for p in examples.split()]
    df = spark.createDataFrame(pairs, "word string, want string").withColumn("got", stem(F.col("word")))
    assert [tuple(r) for r in df.filter("want <> got").collect()] == []


def test_stem_lists_keep_empty_texts(spark):
    df = spark.createDataFrame([(1, ["cats", "cat"]), (2, [])], "doc_id long, words array<string>")
    rows = sorted((r["doc_id"], r["token"]) for r in corpus.stem_lists(df).collect())
    assert rows == [(1, "cat"), (1, "cat"), (2, None)]


def test_windows(spark):
    df = spark.createDataFrame([(1, "i am happy because i am learning".split()), (2, ["too", "short"]), (3, [])], "doc_id long, words array<string>")
    rows = corpus.context_windows(df, F.col("words"), 2).orderBy("pos").collect()
    assert [(r["center"], r["context"]) for r in rows] == [
        ("happy", ["i", "am", "because", "i"]),
        ("because", ["am", "happy", "i", "am"]),
        ("i", ["happy", "because", "am", "learning"]),
    ]
    shares = {r["token"]: r["share"] for r in corpus.word_rows(corpus.context_windows(df, F.col("words"), 2)).filter("pos = 3").collect()}
    assert shares == {"am": 0.5, "happy": 0.25, "i": 0.25}


def test_vocabulary_is_the_same_for_any_partitioning(spark):
    words = spark.createDataFrame([(w,) for w in "b a d c a b".split()], "token string")
    for parts in (1, 3, 20):
        rows = corpus.vocabulary(words.repartition(parts)).orderBy("idx").collect()
        assert [(r["idx"], r["token"]) for r in rows] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_counts_and_maps(spark):
    words = spark.createDataFrame([(w,) for w in "b a c a b a".split()], "token string")
    counts = corpus.frequencies(words)
    assert [tuple(r) for r in corpus.most_common(counts, 2).collect()] == [("a", 3), ("b", 2)]
    assert [tuple(r) for r in corpus.least_common(counts).collect()] == [("c", 1), ("b", 2), ("a", 3)]
    maps = spark.createDataFrame([({"x": {"p": 1, "q": 2}, "y": {"r": 3}},)], "m map<string, map<string, int>>")
    assert sorted(tuple(r) for r in corpus.flattened(maps, "m").collect()) == [("p", 1), ("q", 2), ("r", 3)]
    assert corpus.leaf_count(maps, "m").first()["leaves"] == 3
    flat = spark.createDataFrame([({"p": 3, "q": 1, "r": 2},)], "m map<string, int>")
    assert [tuple(r) for r in corpus.smallest_entries(flat, "m", 2).collect()] == [("q", 1), ("r", 2)]


def test_coverage_of_hand_texts(spark):
    lists = spark.createDataFrame([(1, ["a", "a", "x"]), (2, []), (3, ["x", "y"])], "doc_id long, words array<string>")
    vectors = spark.createDataFrame([("a", [1.0])], "token string, vec array<float>")
    got = {r["metric"]: r["value"] for r in corpus.coverage(lists, vectors).collect()}
    assert abs(got.pop("mean_hit_ratio") - 2 / 9) < 1e-12
    assert got == {"max_words": 3, "min_words": 0, "median_words": 2, "empty_texts": 1, "unique_words": 3, "unique_known": 1}


def test_sketched_coverage_is_near_the_exact_one(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("source"),
        F.transform(F.sequence(F.lit(1), F.col("id") % 41), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(20_000)))).alias("words"),
    )
    rows = rows.withColumn("words", F.when(F.col("doc_id") % 41 == 0, F.array().cast("array<string>")).otherwise(F.col("words")))
    vectors = spark.range(9000).select(F.concat(F.lit("w"), "id").alias("token"))
    sketches = corpus.coverage_sketches(rows, vectors, "source")
    assert sketches.count() == 4
    near = {r["metric"]: r["value"] for r in corpus.sketched_coverage(sketches).collect()}
    exact = {r["metric"]: r["value"] for r in corpus.coverage(rows, vectors).collect()}
    assert near.keys() == exact.keys()
    for name in ("max_words", "min_words", "empty_texts"):
        assert near[name] == exact[name]
    assert abs(near["mean_hit_ratio"] - exact["mean_hit_ratio"]) < 1e-9 and abs(near["median_words"] - exact["median_words"]) <= 1
    for name in ("unique_words", "unique_known"):
        assert abs(near[name] / exact[name] - 1) < 0.03
    # a part's row merges with those made elsewhere
    halves = [corpus.coverage_sketches(rows.filter(f"doc_id % 2 = {i}"), vectors, "source") for i in (0, 1)]
    both = {r["metric"]: r["value"] for r in corpus.sketched_coverage(halves[0].unionByName(halves[1])).collect()}
    assert both["max_words"] == exact["max_words"] and abs(both["unique_words"] / exact["unique_words"] - 1) < 0.03


def test_vectors_in_order_needs_every_word(spark):
    vectors = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "token string, vec array<float>")
    words = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b")], "pos int, token string")
    assert [r["token"] for r in corpus.vectors_in_order(vectors, words).collect()] == ["b", "a", "b"]
    missing = spark.createDataFrame([(0, "zz")], "pos int, token string")
    try:
        corpus.vectors_in_order(vectors, missing).collect()
    except Exception as e:
        assert "no vector for zz" in str(e)
    else:
        raise AssertionError("a missing word passed")


def test_translations(spark):
    entries = spark.createDataFrame([("chile", "wrong", 0), ("peru", "pérou", 1), ("peru", "later", 2), ("mars", "mars", 3)], "source string, target string, entry long")
    words = spark.createDataFrame([("Chile",), ("Peru",)], "w string")
    vectors = spark.createDataFrame([("chili", [1.0]), ("pérou", [2.0]), ("mars", [3.0])], "token string, vec array<float>")
    overrides = spark.createDataFrame([("Chile", "chili", "chili")], "source string, target string, vector_of string")
    rows = sorted((r["source"], r["target"], r["vec"]) for r in corpus.translations(entries, words, vectors, overrides).collect())
    assert rows == [("Chile", "chili", [1.0]), ("Peru", "pérou", [2.0])]


def test_examples_of_numbered_words_equal_those_of_words(spark, monkeypatch):
    from conceptlink.operators import vectors

    monkeypatch.setattr(vectors, "_BLOCK_BITS", 1)
    rows = [(1, "a b a c b d".split()), (2, []), (3, None), (4, ["x", None, "a", "a", "q", "x", "b"]), (4, "b b b b b b".split()), (None, "d c b a b".split())]
    lists = spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(2)
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate("abcdx")], "token string, idx long")
    old = corpus.training_examples(corpus.context_windows(lists, F.col("words"), 2), vocab)
    numbered = corpus.numbered_words(lists, vocab)
    new = corpus.training_examples(corpus.context_windows(numbered, F.col("words"), 2))
    assert new.columns == old.columns and sorted(map(str, new.collect())) == sorted(map(str, old.collect()))
    assert new.count() == 16
    assert "Join" not in corpus.training_examples(corpus.context_windows(lists, F.col("words"), 2))._jdf.queryExecution().optimizedPlan().toString()
