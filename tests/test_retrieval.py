import pytest
from pyspark.sql import functions as F

from tomelight.operators import retrieval, sparse
from tomelight.plans import jobs

INDEX = (
    "chunk_id long, filename string, chunk_text string, is_warning boolean, "
    "embedding array<float>, terms array<int>, weights array<double>"
)


@pytest.fixture(scope="module")
def index(spark):
    # dense scores 0.9, 0.8, 0.7, 0.1; lexical scores 0, 0.5, 0, 1
    rows = [
        (0, "f", "one", False, [0.9, 0.0], [], []),
        (1, "f", "two", True, [0.8, 0.0], [0], [0.5]),
        (2, "g", "three", False, [0.7, 0.0], [], []),
        (3, "g", "four", False, [0.1, 0.0], [0], [1.0]),
    ]
    return spark.createDataFrame(rows, INDEX)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(
        [(10, [1.0, 0.0], [0], [1.0])],
        "query_id long, embedding array<float>, terms array<int>, weights array<double>",
    )


def ranked(df):
    return [(r.chunk_id, round(r.score, 6)) for r in df.orderBy("rank").collect()]


def test_hybrid_candidates(index, queries):
    assert ranked(retrieval.search_hybrid(queries, index, 1)) == [(1, 0.71)]
    assert ranked(retrieval.search_hybrid(queries, index, 1, alpha=0.0)) == [(1, 0.5)]
    boosted = retrieval.search_hybrid(queries, index, 1, intent_weights={"is_warning": 1.5, "none": 3})
    assert ranked(boosted) == [(1, 1.065)]
    order = [c for c, _ in ranked(retrieval.search_hybrid(queries, index, 4, alpha=1.0))]
    assert order == [c for c, _ in ranked(retrieval.search_dense(queries, index, 4))] == [0, 1, 2, 3]


def test_lexical_fills_with_zero_scores(index, queries):
    assert ranked(retrieval.search_lexical(queries, index, 4)) == [(3, 1.0), (1, 0.5), (0, 0.0), (2, 0.0)]


def test_hybrid_grid_equals_broadcast(index, queries):
    grid = retrieval.search_hybrid(queries, index, 1, max_broadcast_rows=0, block_rows=2)
    assert ranked(grid) == [(1, 0.71)]


def test_search_scope_and_projection(index, queries):
    out = retrieval.search(queries, index, filename="g", k=5, method="sbert")
    rows = out.orderBy("rank").collect()
    assert [r.chunk_id for r in rows] == [2, 3] and rows[0].rank == 1
    assert rows[0].text_preview == "three..." and rows[0].full_text == "three"
    assert rows[0].search_scope == "documento 'g'" and rows[0].is_procedure is False
    everything = retrieval.search(queries, index, filename="", k=2)
    assert everything.count() == 2
    unknown = retrieval.search(queries, index, filename="nope")
    assert unknown.columns == out.columns and unknown.count() == 0
    with pytest.raises(ValueError):
        retrieval.search(queries, index, method="bm25")


def test_numeric_flags(index, queries):
    rows = index.withColumn("is_warning", F.when(F.col("is_warning"), 2).otherwise(0))
    assert ranked(retrieval.search_hybrid(queries, rows, 1, intent_weights={"is_warning": 1.5})) == [(1, 1.065)]


def test_stats(index):
    row = retrieval.chunk_stats(index).first()
    assert (row.total_chunks, row.unique_files, row.warnings_detected, row.procedures_detected) == (4, 2, 1, 0)
    assert row.avg_chunk_length == pytest.approx((3 + 3 + 5 + 4) / 4)
    assert retrieval.chunk_stats(index, "g").first().total_chunks == 2
    assert [r.filename for r in retrieval.available_files(index).collect()] == ["f", "g"]


@pytest.mark.parametrize(
    "first, mrr_miss, mrr, hit5, hit10",
    [
        (None, 0.090909, 0.0, 0.0, 0.0),
        (5, 0.095652, 0.008696, 0.043478, 0.043478),
        (6, 0.094203, 0.007246, 0.0, 0.043478),
        (10, 0.091304, 0.004348, 0.0, 0.043478),
    ],
)
def test_published_metrics(spark, first, mrr_miss, mrr, hit5, hit10):
    queries = spark.createDataFrame([(q,) for q in range(23)], "query_id long")
    results = spark.createDataFrame(
        [(q, r, 100 * q + r) for q in range(23) for r in range(1, 11)], "query_id long, rank int, chunk_id long"
    )
    relevant = [(q, 100 * q + 50 + i) for q in range(23) for i in range(3)]
    if first:
        relevant[0] = (0, first)
    qrels = spark.createDataFrame(relevant, "query_id long, chunk_id long")
    row = retrieval.evaluate(results, qrels, queries, 10, miss_rank=11).first()
    assert round(row.mrr, 6) == mrr_miss
    assert (round(row.hit_5, 6), round(row.hit_10, 6), row.hit_1) == (hit5, hit10, 0.0)
    assert row.avg_rank_first_relevant == (first or 10) and row.total_queries == 23
    assert round(retrieval.evaluate(results, qrels, queries, 10).first().mrr, 6) == mrr
    if first == 6:
        assert round(row.ndcg, 6) == 0.007268


def test_index_end_to_end(spark):
    chunks = spark.createDataFrame(
        [(0, "a", "replace the pump filter"), (1, "a", "reset the thermostat"), (2, "b", "pump pressure limits")],
        "chunk_id long, filename string, chunk_text string",
    )
    index = jobs.fit_index(chunks, dim=32)
    asked = spark.createDataFrame([(7, "thermostat reset"), (8, "unknown words")], "query_id long, text string")
    rows = index.search(asked, k=1).collect()
    assert {r.query_id: r.chunk_id for r in rows}[7] == 1 and len(rows) == 2


@pytest.mark.parametrize("size", [3, 8, 20, 500])
def test_pruned_vocabulary_is_exact(spark, size):
    import random

    random.seed(size)
    words = ["pump", "valve", "filter", "reset", "motor", "gauge"] + [f"rare{i}" for i in range(30)]
    weights = [20, 15, 10, 8, 5, 4] + [1] * 30
    rows = [(i, " ".join(random.choices(words, weights, k=25))) for i in range(40)]
    chunks = spark.createDataFrame(rows, "chunk_id long, chunk_text string")
    every = sparse.with_retrieval_terms(chunks, "chunk_text", "g")
    plain = sparse.vocabulary(sparse.postings(every, "chunk_id", "g"), 40, 1, 1.0, size)
    pruned = retrieval.fit_vocabulary(chunks, 40, size)
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, plain.collect()))
