import hashlib

import pytest
from pyspark.sql import functions as F

from tomelight.llm import folders, warc

PAGES = "page_id long, url string, html string"
BIG = "é" * 100 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 50
ROWS = [
    (1, "http://a b\r\nX: 1", BIG), (2, None, BIG), (3, "u", "WARC/1.1\r\n" * 30), (4, "u", None), (5, "u", ""),
    (6, "u", "a" * 99 + "\r\n\r\nWARC/1.1"), (7, "u", "\r\n\r\n" * 60), (8, "u", "\r\n" * 70 + "WARC/1.1\r\n"),
    (9, "u", "日本語" * 200), (10, "u", "日本語" * 200), (11, "u", "\r\n\r\nWARC/1.1" * 20), (12, "u", "z" * 99), (13, "u", "z" * 99),
]


def expected(rows):
    first, out = {}, []
    for id, _, html in sorted(rows, key=lambda r: r[0]):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        of = first.setdefault(digest, id) if len(data) >= 100 else id
        out.append((id, len(data), digest, "response" if of == id else "revisit", None if of == id else of))
    return sorted(out)


def result(df, **options):
    rows = warc.archive_round_trip(df, **options).collect()
    assert all(r.intact for r in rows)
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


@pytest.mark.parametrize("chunk_bytes", [7, 16, 64, 10**6])
def test_round_trip_in_chunks(spark, chunk_bytes):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3)
    for compression in ("none", "gzip"):
        assert result(df, chunk_bytes=chunk_bytes, compression=compression) == expected(ROWS)


def test_payloads_come_back_byte_by_byte(spark):
    path = folders.new_folder(spark, "bytes")
    warc.write_archives(spark.createDataFrame(ROWS, PAGES), path, chunk_bytes=16)
    chunks = warc.read_chunks(spark, path).collect()
    whole = {}
    for c in sorted(chunks, key=lambda c: (c.record_id, c.segment)):
        assert len(c.payload) <= 16
        whole[c.page_id] = whole.get(c.page_id, b"") + bytes(c.payload)
    revisits = {c.page_id for c in chunks if c.record_type == "revisit"}
    assert revisits == {2, 10}
    assert {k: v for k, v in whole.items() if k not in revisits} == {i: (h or "").encode() for i, _, h in ROWS if i not in revisits}


def test_records_follow_the_format(spark):
    path = folders.new_folder(spark, "format")
    warc.write_archives(spark.createDataFrame([(1, "http://x y", "a\r\nb")], PAGES), path, compression="none")
    (file,) = (bytes(r.content) for r in spark.read.format("binaryFile").load(path).filter("length > 0").collect())
    head, http, body = file.split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1:")
    assert b"WARC-Target-URI: http://x%20y\r\n" in head + b"\r\n" and body == b"a\r\nb\r\n\r\n"
    length = int(head.split(b"Content-Length: ")[1])
    assert length == len(http) + 4 + 4 and http.endswith(b"Content-Length: 4")


def test_damage_is_seen(spark):
    chunks = warc.read_chunks(spark, _written(spark))
    broken = chunks.withColumn("payload", F.when(F.col("segment") == 2, F.lit(b"?")).otherwise(F.col("payload")))
    assert {r.intact for r in warc.read_records(broken).filter("segments > 1").collect()} == {False}


def _written(spark):
    path = folders.new_folder(spark, "damage")
    warc.write_archives(spark.createDataFrame([(1, "u", "abc" * 100)], PAGES), path, chunk_bytes=50)
    return path


def test_messy_rows(spark):
    rows = [(None, None, None), (None, "u", "n" * 200), (1, "u", "n" * 200), (1, "u", "n" * 200), (2, "v", "n" * 200), (1, "w", "m")]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("clash") for c in ("copy", "refers_to", "payload_digest", "_first")})
    out = warc.archive_round_trip(df).collect()
    found = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in out)
    assert found == [
        ("1", 1, "response", None), ("1", 200, "response", None), ("1", 200, "response", None),
        ("2", 200, "revisit", 1), ("None", 0, "response", None), ("None", 200, "response", None),
    ]
    assert len({r.record_id for r in out}) == 6
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).collect() == []
