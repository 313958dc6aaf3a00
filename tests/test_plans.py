"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from tomelight.functions import text as tx
from tomelight.operators import chunking, corpus, retrieval, sparse, topk
from tomelight.sources import store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"f{i % 3}", f"pump valve {i} reset the pump. " * 10) for i in range(40)]
    return store.materialize(spark.createDataFrame(rows, "doc_id long, filename string, raw_text string"))


def test_corpus_build_is_map_only(docs):
    text = plan(corpus.build_corpus(docs))
    assert "Exchange" not in text and "PushedFilters: [IsNotNull(raw_text)" in text
    assert "Exchange" not in plan(chunking.chunk(docs, "raw_text"))


def test_unused_columns_are_not_read(docs):
    assert "ReadSchema: struct<raw_text:string>" in plan(corpus.build_corpus(docs).select("tokens"))


def test_cleaning_runs_once(docs):
    # The filter on the token count must not repeat the expression it counts.
    assert plan(corpus.build_corpus(docs).select("tokens")).count("Página|Page") == 1


def test_term_counts_and_rows_need_no_shuffle(docs):
    built = corpus.build_corpus(docs)
    posts = sparse.postings(built)
    assert "Exchange" not in plan(posts)
    vocab = store.materialize(sparse.vocabulary(posts, 40, 1, 1.0, 50))
    rows = sparse.vector_rows(built, sparse.vectorizer(vocab, 40))
    assert "Exchange" not in plan(rows.select("doc_id", "terms", "weights"))


def test_search_shuffles_only_the_best_rows(spark, docs):
    chunks = docs.withColumn("chunk_text", F.col("raw_text")).withColumnRenamed("doc_id", "chunk_id")
    vocab = store.materialize(retrieval.fit_vocabulary(chunks, 40, 50))
    model = sparse.vectorizer(vocab, 40)
    index = store.materialize(retrieval.represent(chunks, model, "chunk_text"))
    asked = spark.createDataFrame([(1, "reset the valve")], "query_id long, text string")
    queries = store.materialize(retrieval.represent(asked, model, "text"))
    text = plan(retrieval.search_dense(queries, index, 3))
    assert text.count("Exchange hashpartitioning(query_id") == 1 and text.count("Exchange") == 1
    assert "WindowGroupLimit" in text and "ReadSchema: struct<chunk_id:bigint,embedding:array<float>>" in text
    scoped = plan(retrieval.search(queries, index, filename="f1", method="sbert"))
    assert "EqualTo(filename,f1)" in scoped


def test_large_query_set_is_not_collected(spark):
    rows = spark.range(50).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    side = topk.side(rows, "id", "v", None, None)
    text = plan(topk.best(side, side, 2, max_broadcast_rows=10, block_rows=20, large="grid"))
    assert "FlatMapCoGroupsInArrow" in text


def test_let_evaluates_once(spark):
    df = spark.range(3).select(F.col("id"), F.array(F.col("id"), F.col("id") + 1).alias("a"))
    text = plan(df.select(tx.term_counts(F.transform("a", lambda x: x * 7)).alias("t")))
    assert text.count("* 7)") == 1
