import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import DOCS, empty, messy
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomelight.llm import folders, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b\n\nc\t d", "", " ", "x\x1cy <|endoftext|>z", "É é ΑΣ Σ", "don't 'S we'LL  q　w\x85r", "日本語 テスト", "\n \n", "Éclair, ÀÇ. Größe. µm ªº İx x., .x a,b <|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("by_word", [True, False])
def test_ids_are_the_tokenizers(tokenizer, by_word):
    made, counts = token_files.WordEncoder(PATH, 1, by_word).lists(pa.array(ODD))
    at = 0
    for text, n in zip(ODD, counts, strict=True):
        assert list(made[at : at + n]) == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        at += n
    assert at == len(made)


def test_words_that_go_straight_to_the_model(tokenizer):
    known = token_files.WordIds(tokenizer)
    assert known.direct
    letters = [chr(c) for c in range(0xC0, 0x100)] + ["İ", "ſ", "K", "Σ"]
    for word in [a + b + c for a in ("", "Ab") for b in letters for c in ("", ".", "!?", "z'", "'s,", "&&&")]:
        assert known.ids(word) == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 2)
    encoder = token_files.WordEncoder(PATH, 1, True)
    for text in ODD * 2:
        assert list(encoder.lists(pa.array([text]))[0]) == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def expected(rows, tokenizer):
    out, at = {}, 0
    for id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.setdefault(id, set()).add((at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark, tokenizer):
    rows = [(i * 3, t) for i, t in enumerate(ODD * 9)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    out = token_files.stored_documents(df, PATH).collect()
    got = {r.doc_id: {(r.start, r.n_tokens, r.ids_crc32)} for r in out}
    assert got == expected(rows, tokenizer)


def test_messy_rows(spark, tokenizer):
    df = messy(spark)
    out = {}
    for r in token_files.stored_documents(df, PATH).collect():
        out.setdefault(r.doc_id, set()).add((r.start, r.n_tokens, r.ids_crc32))
    assert out == expected([tuple(r) for r in df.select("doc_id", "text").collect()], tokenizer)
    assert token_files.stored_documents(empty(spark), PATH).collect() == []


def test_layout_and_selective_reads(spark):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(50))) for i in range(4000)]
    path = folders.new_folder(spark, "layout")
    token_files.write_tokens(spark.createDataFrame(rows, DOCS).repartition(3), path, PATH)
    files = sorted(f.path for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").collect())
    last = -1
    for name in files:
        file = pq.ParquetFile(name.removeprefix("file:"))
        ids = file.read(columns=["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        for g in range(file.metadata.num_row_groups):
            column = {c.path_in_schema: c for c in map(file.metadata.row_group(g).column, range(3))}
            assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
            assert any("DICTIONARY" in e for e in column["ids.list.element"].encodings)
            assert column["doc_id"].has_offset_index and column["doc_id"].has_column_index
    some = token_files.read_tokens(spark, path, 1000, 1003)
    assert [r.doc_id for r in some.orderBy("doc_id").collect()] == [1000, 1001, 1002, 1003]
    plan = token_files.read_tokens(spark, path, 1000).agg(F.sum("n_tokens"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "GreaterThanOrEqual(doc_id,1000)" in plan
