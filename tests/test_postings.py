"""Search over postings against every row scored."""

import numpy as np
import pytest

from tomelight.operators import postings, topk

ROWS = "chunk_id long, terms array<int>, weights array<double>"


def sparse_rows(rng, n, words=400, most=25):
    out = []
    for i in range(n):
        terms = np.unique(rng.zipf(1.4, int(rng.integers(0, most))) % words)
        weights = rng.random(len(terms)) + 0.05
        out.append((i, terms.tolist(), (weights / max(np.linalg.norm(weights), 1e-9)).tolist()))
    return out


def brute(queries, rows, k):
    out = []
    for q, terms, weights in queries:
        own = dict(zip(terms, weights))
        scores = [(-round(sum(own.get(t, 0) * w for t, w in zip(ts, ws)), 6), i) for i, ts, ws in rows]
        out += [(q, r + 1, i) for r, (_, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, queries, rows, k, parts=3):
    df = spark.createDataFrame(rows, ROWS).repartition(parts)
    asked = spark.createDataFrame(queries, ROWS.replace("chunk_id", "query_id"))
    got = postings.search(asked, postings.build(df), k)
    assert got.columns == ["query_id", "rank", "item_id", "score"]
    return sorted((r.query_id, r.rank, r.item_id) for r in got.collect())


@pytest.mark.parametrize("block,group", [(4096, 4096), (16, 5)])
def test_best_rows(spark, monkeypatch, block, group):
    monkeypatch.setattr(postings, "BLOCK", block)
    monkeypatch.setattr(postings, "QUERY_GROUP", group)
    rng = np.random.default_rng(8)
    rows = sparse_rows(rng, 300)
    rows += [(1000 + i, *rows[5][1:]) for i in range(40)]  # ties beyond k
    queries = sparse_rows(rng, 23, most=12) + [(500, [], []), (501, [399, 398], [0.5, 0.5]), (502, [9999], [1.0])]
    for k in (1, 5):
        assert found(spark, queries, rows, k) == brute(queries, rows, k)


def test_few_rows_and_none(spark):
    rows = [(3, [1, 2], [0.6, 0.8]), (4, [2], [1.0]), (5, [], [])]
    queries = [(1, [2], [1.0]), (2, [7], [1.0])]
    assert found(spark, queries, rows, 5) == brute(queries, rows, 5)
    assert found(spark, queries, rows[:0], 5) == [] and found(spark, queries[:0], rows, 5) == []
    with pytest.raises(ValueError):
        found(spark, queries, rows, postings.TOP + 1)


def test_lists_read_follow_the_queries(spark, monkeypatch):
    """Common light terms are not looked up, and blocks that cannot reach the best rows are left out."""
    monkeypatch.setattr(postings, "BLOCK", 10)
    rows = [(i, [0, 1 + i // 10], [0.1, 0.995]) for i in range(200)]
    index = postings.build(spark.createDataFrame(rows, ROWS).coalesce(1))
    asked = postings.asked_terms(spark.createDataFrame([(1, [0, 3], [0.1, 0.9])], ROWS.replace("chunk_id", "query_id")))
    needed = postings.essential(asked, index.terms, 5)
    assert [r.term for r in needed.collect()] == [3]
    assert postings.promising(needed, index.lists).count() == 1 < index.lists.select("block").distinct().count()


def test_equal_to_the_scan(spark):
    rng = np.random.default_rng(3)
    rows, queries = sparse_rows(rng, 200), sparse_rows(rng, 10)
    df, asked = spark.createDataFrame(rows, ROWS), spark.createDataFrame(queries, ROWS.replace("chunk_id", "query_id"))
    scan = topk.nearest(
        topk.side(asked, "query_id", None, "terms", "weights"), topk.side(df, "chunk_id", None, "terms", "weights"), 4, by="lexical", cosine=False
    )
    assert found(spark, queries, rows, 4) == sorted((r.query_id, r.rank, r.item_id) for r in scan.collect())
