"""Alignment of two tokenizers against whole texts encoded and aligned one by one."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import DOCS, empty, messy
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomelight.llm import alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    "Hello  world, it's   fine.\n\n  New\tline éàü ßtraße",
    " leading and trailing ",
    "<|endoftext|> is text, <s> too </s> <0x41>",
    "piece ▁ sign",
    "漢字かな交じり文 and ascii 123 456,789",
    "a b   c\x85d e\x1cf \r\n g",
    "emoji 🙂🙂 x\x00y \x07",
    "a b",
    "a b",
    "x" * 5000 + " " * 300 + "y",
    "don't won't I'll they've",
]


def byte_table():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(rows):
    """Measures of (doc_id, text) by whole texts, byte by byte."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    table = byte_table()
    found, counts = [], Counter()
    for _, text in rows:
        if not text:
            found.append(None)
            continue
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        a_bytes = [bytes(table[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            found.append(None)
            continue
        own_a = [k for k, x in enumerate(a_bytes) for _ in x]
        own_b = [k for k, x in enumerate(b_bytes) for _ in x]
        links = sorted(set(zip(own_a, own_b, strict=True)))
        groups, last = [], (-1, -1)
        for at in range(len(own_a)):
            here = (own_a[at], own_b[at])
            if at + 1 == len(own_a) or (own_a[at + 1] > here[0] and own_b[at + 1] > here[1]):
                ids = [x[last[k] + 1 : here[k] + 1] for k, x in enumerate((a, b))]
                groups.append("|".join(",".join(map(str, x)) for x in ids))
                last = here
        linked = [(a[i], b[j]) for i, j in links]
        counts.update(linked)
        found.append((len(a), len(b), len(groups), linked, ";".join(groups)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for (doc, _), x in zip(rows, found, strict=True):
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[p] == top[p[1]] for p in x[3])
        total = sum(counts[p] for p in x[3])
        out.append((doc, *x[:3], len(x[3]), best, total, hashlib.sha256(x[4].encode()).hexdigest()))
    return sorted(out, key=repr)


def aligned(df, **options):
    rows = alignment.align_documents(df, A, B, **options)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("chunk", [alignment.CHUNK, 1])
def test_hard_texts(spark, chunk):
    rows = list(enumerate(TEXTS))
    assert aligned(spark.createDataFrame(rows, DOCS), chunk=chunk) == brute(rows)


def test_messy_rows(spark):
    df = messy(spark, [(None, TEXTS[0]), (9, TEXTS[0]), (9, TEXTS[4])])
    assert aligned(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert aligned(empty(spark)) == []


def test_given_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    expected = brute(rows)
    assert aligned(df, chunk=20_000) == expected
    assert sum(r[1] > 0 for r in expected) > 100


def test_a_text_is_aligned_once_however_many_copies(spark):
    texts = spark.createDataFrame([(i % 3, f"text {i % 3}") for i in range(300)], DOCS)
    grouped = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = alignment.chunks(grouped, A, B).filter("key IS NOT NULL").collect()
    assert len(rows) == 3
    assert aligned(texts) == brute([(r.doc_id, r.text) for r in texts.collect()])


def test_forgotten_units_are_learned_again():
    units = alignment.Units(alignment.Tokenizers(A, B))
    places = [units[u] for u in ("one", " two ", "two", "x▁")]
    units.learn()
    first = [units.groups[i] for i in places]
    assert first[-1] is None and None not in first[:-1]
    units.forget()
    assert units["two"] == 0
    units.learn()
    assert units.groups == [first[2]]


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**31 - 1])
    packed, lengths = alignment.pack(values)
    assert lengths.tolist() == [1, 1, 1, 2, 2, 3, 3, 4, 5]
    assert alignment.unpack(packed).tolist() == values.tolist()
    assert alignment.unpack(np.zeros(0, np.uint8)).tolist() == []
