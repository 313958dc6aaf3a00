import numpy as np
import pytest
from pyspark.sql import functions as F

from tomelight.functions import text as tx
from tomelight.functions import vectors as vx
from tomelight.operators import contextual


@pytest.fixture(scope="module")
def token_rows(spark):
    return spark.createDataFrame(
        [
            (1, 0, [1.0, -5.0], True),
            (1, 1, [3.0, -7.0], True),
            (1, 2, [9.0, 9.0], False),
            (2, 0, [4.0, 4.0], False),
        ],
        "doc_id long, pos int, vector array<float>, mask boolean",
    )


@pytest.mark.parametrize(
    "how, first, masked",
    [("cls", [1, -5], [4, 4]), ("mean", [2, -6], [0, 0]), ("max", [3, -5], [-1e9, -1e9])],
)
def test_pool(token_rows, how, first, masked):
    got = {r.doc_id: r.embedding for r in contextual.pool(token_rows, how, mask="mask").collect()}
    assert got[1] == first and got[2] == masked


def test_invalid_pooling(token_rows):
    with pytest.raises(ValueError):
        contextual.pool(token_rows, "sum")


def test_normalize_keeps_zeros(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    got = [r.embedding for r in contextual.normalize_rows(df).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]


def test_hashing_encoder(spark):
    import hashlib

    text = "pump valve pump Ñandú"
    expected = np.zeros(16)
    for word in ["pump", "valve", "pump", "ñandú"]:
        h = hashlib.md5(word.encode()).hexdigest()
        expected[int(h[:8], 16) % 16] += -1 if h[8] >= "8" else 1
    expected /= np.linalg.norm(expected)
    df = spark.createDataFrame([(text,), ("...",)], "clean_text string")
    got = [r.embedding for r in contextual.encode(df, dim=16).collect()]
    assert got[0] == pytest.approx(list(expected), abs=1e-6) and got[1] == [0.0] * 16


def test_plugged_encoder(spark):
    def make():
        def run(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return run

    df = spark.createDataFrame([("abc",), ("a",)], "clean_text string")
    got = [r.embedding for r in contextual.encode(df, make_encoder=make, normalize=False).collect()]
    assert got == [[3.0, 1.0], [1.0, 1.0]]
    unit = contextual.encode(df, make_encoder=make).first().embedding
    assert np.linalg.norm(unit) == pytest.approx(1.0)


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(vx.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.0, 1.0])


def test_stats(spark):
    df = spark.createDataFrame([([0.0, 2.0],), ([4.0, 2.0],)], "embedding array<float>")
    row = contextual.stats(df, "m").first()
    assert (row.n_rows, row.dimensionality, row["mean"], row["min"], row["max"], row.sparsity) == (2, 2, 2.0, 0.0, 4.0, 25.0)
    assert row["std"] == pytest.approx(np.std([0, 2, 4, 2]))


def test_projection_and_colors(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame(
        [(i, [float(x) for x in rng.normal(size=4)], "ab"[(i + 1) % 2]) for i in range(20)],
        "doc_id long, embedding array<double>, kind string",
    )
    placed = contextual.projection(df, n_docs=10, color_by="kind")
    assert placed.count() == 10 and 0 < placed.first().explained <= 1
    colors = {(r.category, r.color) for r in contextual.color_points(placed).collect()}
    assert colors == {("b", 0), ("a", 1)}
    plain = contextual.projection(df, color_by="absent")
    assert "category" not in plain.columns
    assert {r.color for r in contextual.color_points(plain).collect()} == {0}


def test_similar_by_model_needs_models():
    with pytest.raises(ValueError):
        contextual.similar_by_model({})


def test_filename_index(spark):
    df = spark.createDataFrame([(9, "b"), (2**40, "c"), (-5, "a")], "doc_id long, filename string")
    got = sorted((r.pos, r.filename, r.total_documents) for r in contextual.filename_index(df).collect())
    assert got == [(0, "a", 3), (1, "b", 3), (2, "c", 3)]


def test_hashed_rows_equal_the_column_expression(spark):
    df = spark.createDataFrame(
        [(1, "a b c a É日本 the"), (2, ""), (3, None), (4, "... !!"), (5, "x " * 50)], "doc_id int, clean_text string"
    )
    plain = vx.l2_normalize(vx.hashed(tx.word_terms(F.col("clean_text")), 16)).cast("array<float>")
    rows = contextual.hashed_embedding(df, "clean_text", 16).select("doc_id", "embedding", plain.alias("plain")).collect()
    assert [r.embedding for r in rows] == [r.plain for r in rows]
    assert contextual.hash_head("a") == contextual.remembered["a"]
