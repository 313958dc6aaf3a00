"""The registered queries over the whole small tables, against their SQL or what their contract says."""

from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tomelight.llm import packing, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")
ROW_PER_DOCUMENT = ["op1_fingerprints", "op4_quality", "op6_token_files", "op7_dartminhash", "op8_lines", "op11_alignment", "op13_simhash"]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_registered():
    names = set(queries.queries()) | {"pipeline"}
    assert names <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    result = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got and got == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", ROW_PER_DOCUMENT)
def test_a_row_per_document(spark, duck, name):
    ids = sorted(r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall())
    assert sorted(r.doc_id for r in queries.queries()[name](spark, SF).select("doc_id").collect()) == ids


def test_exact_passages_are_found(spark, duck):
    found = {(r.doc_id, r.item_id) for r in queries.op10_decontaminate(spark, SF).collect()}
    sql = "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)"
    assert set(duck.execute(sql).fetchall()) <= found


def test_license_lines_are_found(spark, duck):
    found = {r.doc_id for r in queries.op5_licenses(spark, SF).collect()}
    sql = "SELECT doc_id FROM documents WHERE text LIKE '%Licensed under%' OR text LIKE '%MIT License%'"
    assert {r[0] for r in duck.execute(sql).fetchall()} <= found


def test_pipeline(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert docs.columns == columns and 0 < docs.count() <= left
        left = docs.count()
    assert docs.filter("n_chars <> length(text)").isEmpty()
    texts = [r.text for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    for (item,) in duck.execute("SELECT text FROM benchmark").fetchall():
        assert not any(item in t for t in texts)
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in placed} == {r.doc_id for r in docs.collect()}
    bins = defaultdict(int)
    for r in placed:
        bins[r.bin_id, r.capacity] += r.n_tokens
    assert all(min(c for c in packing.LENGTHS if c >= n) == c for (_, c), n in bins.items())
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(whole.collect()) == sorted(placed)
