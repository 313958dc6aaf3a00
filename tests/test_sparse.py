import numpy as np
import pytest
from pyspark.sql import functions as F

from tomelight.operators import simjoin, sparse, topk

DOCS = [(1, ["x", "y"]), (2, ["x"]), (3, ["z", "z"])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, lemmas array<string>")


def table(rows, *names):
    return {tuple(r[n] for n in names[:-1]): round(r[names[-1]], 6) for r in rows}


def test_tfidf_fixture(spark, docs):
    posts = sparse.postings(docs)
    vocab = sparse.vocabulary(posts, 3, 1, 1.0)
    weights = table(sparse.tfidf(posts, vocab, 3).collect(), "doc_id", "term", "weight")
    expected = {(1, "x"): 0.605349, (1, "y"): 0.795961, (2, "x"): 1.0, (3, "z"): 1.0}
    assert weights == expected
    rows = sparse.vector_rows(docs, sparse.vectorizer(vocab, 3))
    assert table(sparse.unpack(rows, vocab).collect(), "doc_id", "term", "weight") == expected
    assert {r.term: r.idx for r in vocab.collect()} == {"x": 0, "y": 1, "z": 2}


def test_max_df_and_max_features(spark, docs):
    posts = sparse.postings(docs)
    assert {r.term for r in sparse.vocabulary(posts, 3, 1, 0.6).collect()} == {"y", "z"}
    assert [r.term for r in sparse.vocabulary(posts, 3, 1, 1.0, 1).collect()] == ["x"]


def test_top_terms_by_name(docs):
    posts = sparse.postings(docs)
    vocab = sparse.vocabulary(posts, 3, 1, 1.0)
    bow, weighted = sparse.bag_of_words(posts, vocab), sparse.tfidf(posts, vocab, 3)
    assert [(r.term, r.score) for r in sparse.top_terms_of("bow", bow, None, 2).collect()] == [("x", 2.0), ("z", 2.0)]
    assert sparse.top_terms_of("anything", bow, weighted, 1).first().term == "x"
    with pytest.raises(ValueError):
        sparse.top_terms_of("tfidf", bow, None)
    sides = sparse.compare_top_terms(bow, weighted, 2).orderBy("rank").collect()
    assert [(r.bow_term, r.tfidf_term) for r in sides] == [("x", "x"), ("z", "z")]


def test_nothing_survives(spark):
    one = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, lemmas array<string>")
    posts = sparse.postings(one)
    vocab = sparse.vocabulary(posts, 1)
    assert sparse.bag_of_words(posts, vocab).count() == 0
    stats = sparse.matrix_stats(sparse.bag_of_words(posts, vocab), F.lit(1), vocab).first()
    assert stats.nnz == 0 and stats.n_terms == 0 and stats.density_pct is None
    for n_docs in (None, 1):
        row = sparse.vector_rows(one, sparse.vectorizer(vocab, n_docs)).first()
        assert (row.doc_id, row.terms, row.weights) == (1, [], [])


def test_matrix_stats_match_dense(spark, docs):
    posts = sparse.postings(docs)
    vocab = sparse.vocabulary(posts, 3, 1, 1.0)
    dense = np.array([[1, 1, 0], [1, 0, 0], [0, 0, 2]])
    row = sparse.matrix_stats(sparse.bag_of_words(posts, vocab), F.lit(3), vocab).first()
    assert row.nnz == 4 and row["min"] == 0 and row["max"] == 2
    assert row["mean"] == pytest.approx(dense.mean()) and row["std"] == pytest.approx(dense.std())
    assert row.sparsity_pct == pytest.approx(100 * 5 / 9)


def test_duplicates_and_self(spark):
    docs = spark.createDataFrame(
        [(1, ["a", "b"]), (2, ["a", "b"]), (3, ["c"])], "doc_id long, lemmas array<string>"
    )
    vocab = sparse.vocabulary(sparse.postings(docs), 3, 1, 1.0)
    rows = sparse.vector_rows(docs, sparse.vectorizer(vocab, 3))
    wanted = spark.createDataFrame([(1,)], "doc_id long")
    hit = sparse.similar(rows, 1, wanted).collect()
    assert [(r.query_id, r.item_id, round(r.score, 6)) for r in hit] == [(1, 2, 1.0)]
    assert [r.item_id for r in sparse.similar(rows, 5, wanted).orderBy("rank").collect()] == [2, 3]
    groups = {r.doc_id: (r.group_id, r.copies) for r in sparse.copy_groups(rows).collect()}
    assert groups == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_proportional_rows_are_copies(spark):
    docs = spark.createDataFrame(
        [(i, ["a", "b", "b"] * n) for i, n in [(5, 3), (6, 7), (7, 1)]] + [(8, ["a"]), (9, ["c"] * 3)],
        "doc_id long, lemmas array<string>",
    )
    vocab = sparse.vocabulary(sparse.postings(docs), 5, 1, 1.0)
    rows = sparse.vector_rows(docs, sparse.vectorizer(vocab, 5)).select("doc_id", "terms", "weights")
    groups = {r.doc_id: (r.group_id, r.copies) for r in sparse.copy_groups(rows).collect()}
    assert groups == {5: (5, 3), 6: (5, 3), 7: (5, 3), 8: (8, 1), 9: (9, 1)}
    (edge,) = sparse.similarity_edges(rows, 0.1).collect()
    assert (edge.left_id, edge.right_id, edge.left_copies, edge.right_copies) == (5, 8, 3, 1)


@pytest.fixture(scope="module")
def random_rows(spark):
    rng = np.random.default_rng(3)
    matrix = rng.random((90, 12)) * (rng.random((90, 12)) < 0.4)
    matrix[40:70] = matrix[40]  # a third of all rows are copies
    matrix[5] = 0
    rows = [
        (i, [int(j) for j in np.flatnonzero(r)], [float(x) for x in r[r != 0]])
        for i, r in enumerate(matrix)
    ]
    df = spark.createDataFrame(rows, "doc_id long, terms array<int>, weights array<double>")
    norms = np.sqrt((matrix**2).sum(1))
    unit = matrix / np.where(norms == 0, 1, norms)[:, None]
    return df, unit @ unit.T


def brute(sims, k):
    out = {}
    for i in range(len(sims)):
        order = sorted((-round(s, 6), j) for j, s in enumerate(sims[i]) if j != i)
        out[i] = [j for _, j in order[:k]]
    return out


@pytest.mark.parametrize(
    "blocks", [{}, {"block_rows": 7}, {"max_broadcast_rows": 3, "block_rows": 16}, {"method": "postings"}]
)
def test_similar_matches_brute_force(random_rows, blocks):
    df, sims = random_rows
    found = {}
    for r in sparse.similar(df, 4, **blocks).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.item_id)
    assert found == brute(sims, 4)


@pytest.mark.parametrize(
    "options", [{}, {"method": "grid"}, {"method": "grid", "block_rows": 9}, {"method": "index"}, {"method": "index", "list": 4}]
)
def test_edges_match_brute_force(random_rows, options, monkeypatch):
    options = dict(options)
    monkeypatch.setattr(simjoin, "LIST", options.pop("list", simjoin.LIST))
    df, sims = random_rows
    copies = set(range(41, 70))
    expected = {
        (i, j): (round(sims[i, j], 6), 30 if i == 40 else 1, 30 if j == 40 else 1)
        for i in range(90)
        for j in range(i + 1, 90)
        if i not in copies and j not in copies and round(sims[i, j], 6) >= 0.5
    }
    found = {
        (r.left_id, r.right_id): (round(r.cosine, 6), r.left_copies, r.right_copies)
        for r in sparse.similarity_edges(df, 0.5, **options).collect()
    }
    assert found == expected


@pytest.mark.parametrize("floor", [0.2, 0.6, 0.95])
def test_index_finds_every_pair_of_a_wide_vocabulary(spark, floor, monkeypatch):
    monkeypatch.setattr(simjoin, "LIST", 25)
    rng = np.random.default_rng(11)
    rows = []
    for i in range(260):
        n = int(rng.integers(1, 30))
        terms = np.unique(np.concatenate([rng.zipf(1.3, n) % 3000, [0] if i % 3 else [7]]))  # 0: a term of most rows
        rows.append([i, terms, rng.random(len(terms)) + 0.01])
        if i % 10 == 0:
            noise = rng.random(len(terms)) * 0.3
            rows.append([1000 + i, terms, rows[-1][2] + noise])
    rows += [[2000, np.zeros(0, int), np.zeros(0)], [2001, np.array([5]), np.array([1.0])], [2002, np.array([5]), np.array([9.0])]]
    matrix = np.zeros((len(rows), 3001))
    for k, (_, t, w) in enumerate(rows):
        matrix[k, t] = w
    norms = np.sqrt((matrix**2).sum(1))
    unit = matrix / np.where(norms == 0, 1, norms)[:, None]
    cosine = np.round(unit @ unit.T, 6)
    ids = [r[0] for r in rows]
    expected = {
        (min(ids[i], ids[j]), max(ids[i], ids[j])): cosine[i, j]
        for i in range(len(ids)) for j in range(i) if cosine[i, j] >= floor
    }
    df = spark.createDataFrame([(i, t.tolist(), w.tolist()) for i, t, w in rows], "id long, terms array<int>, weights array<double>")
    found = {(r.left_id, r.right_id): round(r.cosine, 6) for r in simjoin.pairs_at_least(df, floor, "index").collect()}
    assert found == pytest.approx(expected, abs=2e-6) and set(found) == set(expected)


def test_index_carries_prefixes_only(spark):
    """A row is listed under the terms from which on its norm reaches the floor."""
    rows = spark.createDataFrame(
        [(i, [0, 1, 10 + i], [1.0, 1.0, 6.0]) for i in range(40)], "id long, terms array<int>, weights array<double>"
    )
    listed = simjoin.prefixes(rows, 0.5)
    assert {r.term for r in listed.collect()} == {10 + i for i in range(40)}
    assert simjoin.pairs_at_least(rows, 0.5).collect() == []
    with pytest.raises(ValueError):
        simjoin.pairs_at_least(rows, 0.5, "other")


def test_string_ids_and_large_query_grid(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 5))
    df = spark.createDataFrame(
        [(f"w{i:02d}", [float(x) for x in v]) for i, v in enumerate(vectors)], "word string, vector array<float>"
    )
    side = topk.side(df, "word", "vector", None, None)
    small = topk.nearest(side, side, 3, skip_self=True)
    grid = topk.nearest(side, side, 3, skip_self=True, max_broadcast_rows=5, block_rows=11)
    rows = sorted((r.query_id, r.rank, r.item_id) for r in small.collect())
    assert rows == sorted((r.query_id, r.rank, r.item_id) for r in grid.collect())


def test_small_corpus_meets_many_queries(spark):
    rng = np.random.default_rng(4)
    q, c = rng.normal(size=(50, 4)), rng.normal(size=(6, 4))

    def side(rows):
        df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, v array<double>")
        return topk.side(df, "id", "v", None, None)

    found = topk.nearest(side(q), side(c), 2, cosine=False, max_broadcast_rows=10)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    scores = q @ c.T
    expected = sorted((i, r + 1, int(j)) for i in range(50) for r, j in enumerate(np.argsort(-scores[i])[:2]))
    assert sorted((r.query_id, r.rank, r.item_id) for r in found.collect()) == expected


def test_running_best_is_pruned(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLICE_ROWS", 5)
    rng = np.random.default_rng(6)
    vectors = rng.integers(0, 3, size=(80, 3)).astype(float)  # many ties
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, v array<double>")
    side = topk.side(df, "id", "v", None, None)
    found = topk.nearest(side, side.coalesce(1), 3, cosine=False)
    scores = vectors @ vectors.T
    expected = [(i, r + 1, j) for i in range(80) for r, j in enumerate(sorted(range(80), key=lambda j: (-scores[i, j], j))[:3])]
    assert sorted((r.query_id, r.rank, r.item_id) for r in found.collect()) == expected


def test_result_does_not_depend_on_partitions(spark, docs):
    posts = sparse.postings(docs)
    vocab = sparse.vocabulary(posts, 3, 1, 1.0)
    once = sparse.tfidf(posts, vocab, 3).collect()
    many = sparse.tfidf(sparse.postings(docs.repartition(3)), vocab, 3).collect()
    assert sorted(once) == sorted(many)


def test_retrieval_terms(spark):
    df = spark.createDataFrame([("The red pump a b is red",)], "t string")
    row = sparse.with_retrieval_terms(df, "t", "g").first().g
    assert row == ["red", "pump", "red", "red pump", "pump red"]


@pytest.mark.parametrize(
    "options", [{}, {"method": "grid"}, {"method": "grid", "block_rows": 9}, {"method": "index"}, {"method": "index", "list": 4}, {"method": "index", "dense": 0}]
)
def test_links_match_brute_force(random_rows, options, monkeypatch):
    """One row per document, copies included; the links of its class are counted where they are found."""
    options = dict(options)
    monkeypatch.setattr(simjoin, "LIST", options.pop("list", simjoin.LIST))
    monkeypatch.setattr(simjoin, "DENSE", options.pop("dense", simjoin.DENSE))
    df, sims = random_rows
    first = {i: 40 if i in range(40, 70) else i for i in range(90)}
    classes = sorted(set(first.values()))
    cosine = np.round(sims, 6)
    expected = {}
    for i in range(90):
        near = [cosine[first[i], j] for j in classes if j != first[i] and cosine[first[i], j] >= 0.5]
        expected[i] = (first[i], 30 if first[i] == 40 else 1, len(near), round(sum(near), 6))
    found = {r.doc_id: (r.class_id, r.copies, r.links, round(r.total, 6)) for r in sparse.similarity_links(df, 0.5, **options).collect()}
    assert found == expected


def test_a_grid_does_not_copy_rows_with_the_table(spark):
    """Blocks of a side are bounded, so each row is copied a bounded number of times."""
    rows = spark.range(5000).select("id", F.array(F.lit(1)).alias("terms"), F.array(F.lit(1.0)).alias("weights"))
    left, right = topk.triangle(rows, 10)
    assert left.count() + right.count() <= 5000 * (topk.GRID_BLOCKS + 1)
    assert topk.block_count(rows, 10) == topk.GRID_BLOCKS


def test_pairs_under_a_rarer_term_are_not_looked_at_one_by_one():
    """A cell whose pairs all share a rarer term gives none of them, without a row of the matrix for each."""
    import tracemalloc

    import pyarrow as pa

    n, columns = 700, 400
    ones = np.ones(n, np.int64)
    terms = pa.array([list(range(columns))] * n, pa.list_(pa.int32()))
    run = pa.table(
        {"term": ones * (columns - 1), "i": ones * 0, "j": ones * 0, "own": ones * 0, "w": ones * 0.5, "rest": ones * 0.8, "id": np.arange(n),
         "terms": terms, "weights": pa.array(np.ones((n, columns)).tolist(), pa.list_(pa.float64()))}
    )
    counts = np.ones(simjoin.SLOTS, np.int64)
    tracemalloc.start()
    assert sum(len(a) for a, *_ in simjoin.met(run, 0.8, counts)) == 0
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()
