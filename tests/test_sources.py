import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptlink.operators.clustering import MiniBatchKMeans
from conceptlink.operators import staging
from conceptlink.operators.staging import drop_staging, staging_root, written
from conceptlink.sources import tables, vectors
from conceptlink.streaming import documents as stream_docs


def gaps(spark):
    return spark.createDataFrame([(1, "a", "['x']"), (2, None, "['y']"), (None, None, None)], tables.DOCUMENT_SCHEMA)


def test_missing_rows(spark):
    df = gaps(spark)
    assert tables.missing_share(df).first()[0] == pytest.approx(2 / 3)
    assert tables.incomplete_rows(df).count() == 2
    assert tables.drop_incomplete(df).count() == 1
    with pytest.raises(Exception, match="missing values"):
        tables.drop_incomplete(df, how="all").collect()


def test_csv_round_trip_with_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([(1, 'He said "no",\nthen left', "['a', 'b']"), (2, "plain", "[]")], tables.DOCUMENT_SCHEMA)
    path = str(tmp_path / "docs")
    tables.write_csv(df, path)
    assert sorted(map(tuple, tables.read_documents(spark, path).collect())) == sorted(map(tuple, df.collect()))
    assert tables.read_documents(spark, path, n=1).count() == 1


def test_matrix_splits_are_pruned(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id long, features array<double>")
    for split in ("train", "test", "simple-train", "simple-test", "doc"):
        tables.save_matrix(rows if split != "test" else rows.filter("id = 2"), path, split)
    train, test = tables.load_pair_vectors(spark, path)
    assert (train.count(), test.count()) == (2, 1)
    assert tables.load_document_vectors(spark, path).columns == ["id", "features"]
    files = tables.load_matrix(spark, path, "doc").inputFiles()
    assert files and all("split=doc/run=0" in f for f in files)


def test_splits_keep_their_own_columns(spark, tmp_path):
    path = str(tmp_path / "m")
    tables.save_matrix(spark.createDataFrame([(1, [1.0])], "doc_id long, vec array<double>"), path, "doc")
    pairs = spark.createDataFrame([(1, "c", [2.0], 1)], "doc_id long, concept string, features array<double>, label int")
    for split in ("train", "test"):
        tables.save_matrix(pairs, path, split)
    for part in tables.load_pair_vectors(spark, path):
        assert part.columns == pairs.columns and [tuple(r) for r in part.collect()] == [(1, "c", [2.0], 1)]
    assert tables.load_document_vectors(spark, path).columns == ["doc_id", "vec"]


def test_dictionary_order_goes_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("en fr\ncat first\n")
    (tmp_path / "b.csv").write_text("en fr\ncat later\n" + "x y\n" * 1000)
    first = tables.read_dictionary(spark, str(tmp_path)).filter("source = 'cat'").agg(F.min_by("target", "entry"))
    assert first.first()[0] == "first"


def test_vectors_text_form(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("2 3\nking 0.5 -1 2\nqueen 1 2 3 \n")
    rows = {r["token"]: r["vec"] for r in vectors.read_vectors_text(spark, str(path)).collect()}
    assert rows == {"king": [0.5, -1.0, 2.0], "queen": [1.0, 2.0, 3.0]}
    stored = str(tmp_path / "stored")
    vectors.write_vectors(vectors.read_vectors_text(spark, str(path)), stored)
    assert vectors.read_vectors(spark, stored).count() == 2


def test_dictionary_and_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.csv").write_text("en fr\ncat chat\ndog chien\n")
    (tmp_path / "x.dat").write_text("1")
    (tmp_path / "y.txt").write_text("1")
    rows = tables.read_dictionary(spark, str(tmp_path / "sub" / "d.csv")).orderBy("entry").collect()
    assert [(r["source"], r["target"]) for r in rows] == [("cat", "chat"), ("dog", "chien")]
    names = {r["path"].rsplit("/", 1)[1] for r in tables.list_files(spark, str(tmp_path)).collect()}
    assert names == {"d.csv", "x.dat"}


def test_filters_and_columns_reach_the_scan(spark, tiny):
    docs = tables.read_documents(spark, f"{tiny}/documents.parquet", "doc_id long, text string, lang string, source string, n_chars long", "parquet")
    plan = docs.filter("lang = 'en'").select("doc_id", "lang")._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(lang,en)" in plan
    scan = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in scan


def test_staging_follows_the_session_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert staging_root(spark).startswith(folder.rstrip("/"))
    copy = written(spark.range(5))
    assert copy.count() == 5
    assert "Scan parquet" in copy._jdf.queryExecution().executedPlan().toString() or "FileScan parquet" in copy._jdf.queryExecution().executedPlan().toString()


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda spark: str(tmp_path / "staged"))
    written(spark.range(3))
    assert (tmp_path / "staged").exists()
    drop_staging(spark)
    assert not (tmp_path / "staged").exists()


def test_streamed_documents(spark, tmp_path, tiny):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs = spark.createDataFrame([(1, "known word"), (2, "nothing"), (3, "")], "doc_id long, text string").repartition(3)
    docs.write.parquet(source)
    known = spark.createDataFrame([("known", [1.0, 2.0])], "token string, vec array<float>")
    stream = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(source)
    writer = stream_docs.vectorize(stream, known, out).option("checkpointLocation", str(tmp_path / "cp"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    rows = {r["doc_id"]: r["vec"] for r in spark.read.parquet(out).collect()}
    assert rows == {1: [1.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_streamed_centres(spark, tmp_path):
    source = str(tmp_path / "in")
    points = spark.range(60).select("id", F.array((F.col("id") % 2) * 10.0 + F.col("id") / 100).alias("vec"))
    points.repartition(3).write.parquet(source)
    learner = MiniBatchKMeans(2)
    stream = spark.readStream.schema("id long, vec array<double>").option("maxFilesPerTrigger", 1).parquet(source)
    query = stream_docs.update_centers(stream, learner).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert learner.assign(points).groupBy("cluster_id").count().count() == 2


def test_streamed_centres_survive_a_restart(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    points = spark.range(120).select("id", F.array((F.col("id") % 3) * 10.0 + F.col("id") / 100, F.lit(1.0)).alias("vec"))
    points.repartition(4).write.parquet(source)

    def run(learner, checkpoint, limit=None):
        seen = []

        def step(batch, number):
            if limit is not None and len(seen) == limit:
                raise RuntimeError("killed")
            learner.update(batch, number)
            seen.append(number)

        stream = spark.readStream.schema("id long, vec array<double>").option("maxFilesPerTrigger", 1).parquet(source)
        query = stream.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception:
            assert limit is not None
        return seen

    plain = MiniBatchKMeans(3)
    assert run(plain, "cp1") == [0, 1, 2, 3]
    assert run(MiniBatchKMeans(3, path=state), "cp2", limit=2) == [0, 1]
    later = MiniBatchKMeans(3, path=state)
    assert run(later, "cp2") == [2, 3]
    assert np.allclose(later.centers, plain.centers) and later.weights == plain.weights and sum(plain.weights) == 120
    again = MiniBatchKMeans(3, path=state)
    again.restore(spark)
    assert again.centers == later.centers
    # a finished batch that comes again changes nothing, whatever it holds
    again.update(points, 3)
    assert again.centers == later.centers and again.weights == later.weights
    with pytest.raises(ValueError):
        again.update(points)


def test_minibatch_steps_are_weighted_means(spark):
    learner = MiniBatchKMeans(1, decay=0.5)
    batches = [[1.0, 2.0, 6.0], [10.0], [4.0, 8.0]]
    center, weight = None, 0.0
    for n, values in enumerate(batches):
        learner.update(spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, vec array<double>"))
        total = weight * 0.5 * (center or 0.0) + sum(values)
        weight = weight * 0.5 + len(values)
        center = total / weight
        assert abs(learner.centers[0][0] - center) < 1e-12 and learner.weights == [weight]
