import json

from pyspark.sql import functions as F

from tomelight.operators import sparse
from tomelight.sources import files, store
from tomelight.streaming import ingest


def test_files_and_failures(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"good text")
    (tmp_path / "b.pdf").write_bytes(b"\xff\xfe broken")
    (tmp_path / "c.PDF").write_bytes(b"upper")
    (tmp_path / "d.txt").write_bytes(b"other")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.pdf").write_bytes(b"nested")
    found = files.list_files(spark, str(tmp_path))
    assert sorted(r.filename for r in found.collect()) == ["a.pdf", "b.pdf"]
    texts = files.extract_text(found, lambda content: content.decode("utf-8")).collect()
    assert [(r.filename, r.raw_text) for r in texts] == [("a.pdf", "good text")]
    decoded = files.decode_files(found, lambda content: content.decode("utf-8")).collect()
    assert {r.filename: (r.error or "").split(":")[0] for r in decoded} == {"a.pdf": "", "b.pdf": "UnicodeDecodeError"}


def test_page_texts(spark):
    df = spark.createDataFrame(
        [(1, "u", "<html><script>x<b></script><p>A&amp;B</p><!-- <p> --><style>p{}</style> c</html>"), (2, "v", "<p></p>")],
        "page_id long, url string, html string",
    )
    assert [(r.filename, r.raw_text) for r in files.page_texts(df).collect()] == [("u", "A&B c")]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.5, 2.5], ["a"])], "id long, v array<float>, t array<string>")
    store.save_table(df, str(tmp_path / "t"))
    again = store.load_table(spark, str(tmp_path / "t"))
    assert again.collect() == df.collect() and again.schema["v"].dataType == df.schema["v"].dataType
    store.save_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().t == ["a"]
    assert store.materialize(df).collect() == df.collect()


def test_vocabularies_json(spark, tmp_path):
    docs = spark.createDataFrame([(1, ["b", "a"]), (2, ["a", "b"])], "doc_id long, lemmas array<string>")
    vocab = sparse.vocabulary(sparse.postings(docs), 2, 1, 1.0)
    store.save_vocabularies(vocab, None, str(tmp_path / "v"))
    (part,) = (tmp_path / "v").glob("part-*")
    assert json.loads(part.read_text()) == {"bow_vocab": {"a": 0, "b": 1}, "tfidf_vocab": None}


def test_labelled_json(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('[\n {"text": "how?", "label": "how_to"},\n {"text": "q", "label": "other"}\n]')
    assert [tuple(r) for r in files.read_labelled(spark, str(path)).collect()] == [("how?", "how_to"), ("q", "other")]


def test_streaming_corpus(spark, tmp_path):
    schema = "doc_id long, filename string, raw_text string"
    landing, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    batches = [[(1, "a", "The pump starts. It runs."), (2, "b", "")], [(3, "c", "Valve closes now please, thanks.")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        arriving = ingest.arriving_documents(spark, landing, schema)
        ingest.write_corpus(arriving, out, chk).awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("doc_id").collect()
    assert [(r.doc_id, r.lemmas) for r in rows] == [(1, ["pump", "start", "run"]), (3, ["valve", "close", "please", "thank"])]
    pieces = str(tmp_path / "pieces")
    arriving = ingest.arriving_documents(spark, landing, schema)
    ingest.write_corpus(arriving, pieces, chk + "2", chunks=True).awaitTermination(120)
    assert spark.read.parquet(pieces).filter(F.col("doc_id") == 3).first().num_words == 5


def test_intermediate_folders(spark, tmp_path):
    df = spark.range(5)
    one, two = (str(tmp_path / name) for name in ("one", "two"))
    kept = store.materialize(df, one)
    assert store.materialize(df, two).count() == kept.count() == 5
    assert store.application_folder(spark, one) != store.application_folder(spark, two)
    assert store.clear(spark, two) and not store.clear(spark, two)
    assert not list((tmp_path / "two").rglob("*.parquet")) and kept.count() == 5


def test_collected_tables_can_be_removed(spark, tmp_path):
    before = store.materialize(spark.range(3), str(tmp_path))
    with store.collecting() as made:
        store.materialize(spark.range(4), str(tmp_path))
    store.materialize(spark.range(5), str(tmp_path))
    assert len(made) == 1
    store.remove(spark, made)
    assert not list((tmp_path / "tomelight").rglob(made[0].rsplit("/", 1)[1])) and before.count() == 3


def test_folder_of_the_session(spark):
    given = spark.conf.get("spark.checkpoint.dir")
    assert store.shared_folder(spark) == given.rstrip("/")
    assert store.shared_folder(spark, "/else/") == "/else"


def test_an_intermediate_table_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with store.without_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before

    def shuffled(write):
        held = spark._jsc.sc().env().blockManager().diskBlockManager()
        files = lambda: {b.toString() for b in map(held.getAllBlocks().apply, range(held.getAllBlocks().size())) if b.isShuffle()}
        old = files()
        write(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count())
        return files() - old

    assert shuffled(lambda df: df.write.format("noop").mode("overwrite").save())
    assert not shuffled(store.materialize)
