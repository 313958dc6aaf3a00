"""WARC archives written and read as tables of bounded chunks.

A payload is cut into chunks, and every chunk becomes one WARC record: the first
is the response, further ones are continuation records (WARC segmentation), each
with its segment number and the SHA-256 of the payload so far. No row
holds more than a chunk, in either direction, and digests are carried from chunk
to chunk. Of records with equal payloads of at least ``MIN_REVISIT`` bytes that
with the smallest page id is the response; the others are revisit records.

The archives are text files for Spark: the reader splits them at the line that
opens a record. The writer cuts a chunk wherever its content would look like that
line, so the split is exact for every payload; gzip is optional.

Defined results: a null html is an empty payload; a null url becomes the
page's own URN; white space and control characters in a url are percent-encoded;
rows with a null page_id are responses; a page_id given by several rows gets one
record for each; an empty table gives empty archives. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .folders import new_folder

CHUNK_BYTES = 256 * 1024
MIN_REVISIT = 100
#: Fixed values of the format.
VERSION = b"WARC/1.1"
OPENING = b"\r\n\r\n" + VERSION
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

CHUNKS = "record_id string, page_id long, record_type string, refers_to long, segment long, \
payload_bytes long, declared string, running string, payload binary"
RECORDS = "record_id string, page_id long, record_type string, refers_to long, \
payload_bytes long, payload_digest string, intact boolean, segments long"


def assign(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Pages with payload_bytes, payload_digest and ``refers_to``, the page they revisit.

    Only ids and digests are grouped; the html moves once, to meet the assignment.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    size, digest = F.octet_length("html").cast("long"), F.sha2("html", 256)
    keys = rows.filter((size >= min_bytes) & F.col("page_id").isNotNull()).select(
        "page_id", digest.alias("_digest")
    )
    firsts = (
        keys.groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"))
        .filter("_first < _last")
        .drop("_last")
    )
    revisits = (
        keys.join(firsts, "_digest")
        .filter("page_id > _first")
        .groupBy("page_id", "_digest")
        .agg(F.min("_first").alias("refers_to"))
    )
    rows = rows.withColumn("payload_digest", digest).withColumn("payload_bytes", size)
    joined = rows.join(
        revisits.withColumnRenamed("page_id", "_page"),
        (F.col("page_id") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")),
        "left",
    )
    copy = F.row_number().over(Window.partitionBy("page_id", "payload_digest").orderBy("url"))
    return joined.withColumn("copy", copy).drop("_page", "_digest")


def safe_end(data: memoryview, start: int, limit: int) -> int:
    """End of the chunk that begins at ``start``: whole characters, no opening line within."""
    end = min(start + limit, len(data))
    while start < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    # The line before a chunk is empty, so an opening line may begin up to four bytes earlier.
    found = (b"\r\n\r\n" + bytes(data[start:end])).find(OPENING)
    return end if found < 0 else start + found + 4


def head(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", length)] if v is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"


def records_of(row: dict, data: memoryview, limit: int) -> Iterator[bytes]:
    """The WARC records of one page, without their last line feed."""
    page = "" if row["page_id"] is None else row["page_id"]
    name = f"urn:page:{page}:{row['payload_digest'][:16]}:{row['copy']}"
    url = re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["url"] or f"urn:page:{page}")
    revisit = row["refers_to"] is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    if revisit:
        fields += [
            ("WARC-Refers-To", f"<urn:page:{row['refers_to']}:{row['payload_digest'][:16]}:1>"),
            ("WARC-Profile", PROFILE),
        ]
        yield head(fields, len(http)) + http + b"\r\n\r"
        return
    digest, start, segment = hashlib.sha256(), 0, 0
    while start < len(data) or not segment:
        end = safe_end(data, start, limit)
        part = bytes(data[start:end])
        digest.update(part)
        segment += 1
        last = end == len(data)
        if segment == 1:
            mine = fields if last else [*fields, ("WARC-Segment-Number", 1)]
            part = http + part
        else:
            mine = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<{name}:{segment}>"),
                ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", f"<{name}>"),
                ("WARC-Segment-Number", segment),
                ("WARC-Segment-Total-Length", len(data) if last else None),
            ]
        if segment > 1 or not last:
            mine = [*mine, ("X-Payload-Digest-So-Far", f"sha256:{digest.hexdigest()}")]
        yield head(mine, len(part)) + part + b"\r\n\r"
        start = end


def write_archives(
    pages: DataFrame,
    path: str,
    chunk_bytes: int = CHUNK_BYTES,
    min_bytes: int = MIN_REVISIT,
    compression: str = "gzip",
    max_records: int = 100_000,
) -> None:
    """Write one record per page, or several for a page of more than ``chunk_bytes``."""

    def archive(batches):
        for batch in batches:
            payloads = batch.column("html").cast(pa.large_binary())
            rest = batch.drop_columns(["html"]).to_pylist()
            for i, row in enumerate(rest):
                data = memoryview(payloads[i].as_buffer())
                for record in records_of(row, data, chunk_bytes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([record], pa.binary()).cast(pa.string())], ["value"]
                    )

    def grouped(batches):
        held, size = [], 0
        for batch in archive(batches):
            held.append(batch.column(0))
            size += batch.nbytes
            if size > 4 * chunk_bytes:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(held)], ["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(held)], ["value"])

    rows = assign(pages, min_bytes).select(
        "page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to", "copy"
    )
    html = F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("").alias("html")
    rows = rows.select(*[c for c in rows.columns if c != "html"], html)
    rows.mapInArrow(grouped, "value string").write.option("compression", compression).option(
        "maxRecordsPerFile", max_records
    ).text(path)


def field(head: str, name: str) -> str | None:
    at = head.find(f"\r\n{name}: ")
    return head[at + len(name) + 4 :].split("\r\n", 1)[0] if at >= 0 else None


def page_of(name: str | None) -> int | None:
    number = (name or "").strip("<>").split(":")[2:3]
    return int(number[0]) if number and number[0] else None


def parse(data: memoryview) -> dict:
    """One record, from the line after its opening to its content's declared end."""
    if bytes(data[: len(VERSION) + 2]) == VERSION + b"\r\n":  # the first of a file
        data = data[len(VERSION) + 2 :]
    begin = bytes(data[:8192]).find(b"\r\n\r\n")
    if begin < 0:
        begin = bytes(data).find(b"\r\n\r\n")
    top = "\r\n" + bytes(data[:begin]).decode()
    kind, length = field(top, "WARC-Type"), int(field(top, "Content-Length"))
    block = data[begin + 4 : begin + 4 + length]
    declared, running = field(top, "WARC-Payload-Digest"), field(top, "X-Payload-Digest-So-Far")
    name = field(top, "WARC-Segment-Origin-ID") or field(top, "WARC-Record-ID")
    size = None
    if kind != "continuation":
        body = bytes(block[:4096]).find(b"\r\n\r\n") + 4
        size = int(field("\r\n" + bytes(block[:body]).decode(), "Content-Length"))
        block = block[body:]
    return {
        "record_id": name.strip("<>"),
        "page_id": page_of(name),
        "record_type": kind,
        "refers_to": page_of(field(top, "WARC-Refers-To")),
        "segment": int(field(top, "WARC-Segment-Number") or 0),
        "payload_bytes": size,
        "declared": declared and declared.removeprefix("sha256:"),
        "running": running and running.removeprefix("sha256:"),
        "payload": bytes(block),
    }


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of archives: one row per WARC record, keyed by record_id and segment."""
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("segment", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("declared", pa.string()),
            ("running", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def parsed(batches):
        for batch in batches:
            values = batch.column(0).cast(pa.large_binary())
            for start in range(0, len(values), 64):
                found = [
                    parse(memoryview(v.as_buffer())) for v in values[start : start + 64]
                ]
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    lines = spark.read.option("lineSep", (OPENING + b"\r\n").decode()).text(path)
    return lines.mapInArrow(parsed, CHUNKS)


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per page record, its payload's digest taken over its chunks in turn.

    Whole records are digested where they are read; chunks of longer payloads meet
    by record and stream through one running digest. ``intact``: size, all running
    digests and the final one agree with what the archive declares.
    """
    whole = F.col("segment") == 0
    kept = F.when(whole, F.lit(None)).otherwise(F.col("payload"))
    own = F.when(whole & (F.col("record_type") == "response"), F.sha2("payload", 256))
    rows = chunks.select(
        "record_id", "page_id", "record_type", "refers_to", "segment", "payload_bytes",
        "declared", "running", F.octet_length("payload").cast("long").alias("size"),
        own.alias("own"), kept.alias("payload"),
    )

    def finished(first: dict, digest: str, size: int, good: bool, segments: int) -> dict:
        revisit = first["record_type"] == "revisit"
        digest, size = (first["declared"], first["payload_bytes"]) if revisit else (digest, size)
        return {
            "record_id": first["record_id"],
            "page_id": first["page_id"],
            "record_type": first["record_type"],
            "refers_to": first["refers_to"],
            "payload_bytes": size,
            "payload_digest": digest,
            "intact": good and digest == first["declared"] and size == first["payload_bytes"],
            "segments": segments,
        }

    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("intact", pa.bool_()),
            ("segments", pa.int64()),
        ]
    )

    def digested(batches):
        first, digest, size, good, segments = None, None, 0, True, 0
        for batch in batches:
            out = []
            payloads = batch.column("payload")
            for i, row in enumerate(batch.drop_columns(["payload"]).to_pylist()):
                if first and row["record_id"] != first["record_id"]:
                    out.append(finished(first, digest.hexdigest(), size, good, segments))
                    first = None
                if row["segment"] == 0:
                    out.append(finished(row, row["own"], row["size"], True, 1))
                    continue
                if first is None:
                    first, digest, size, good, segments = row, hashlib.sha256(), 0, True, 0
                digest.update(payloads[i].as_buffer())
                size += row["size"]
                segments += 1
                good = good and row["segment"] == segments and row["running"] == digest.hexdigest()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if first:
            out = [finished(first, digest.hexdigest(), size, good, segments)]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    met = rows.repartition("record_id").sortWithinPartitions("record_id", "segment")
    return met.mapInArrow(digested, RECORDS)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives of all pages below the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write_archives(pages, path, **options)
    return read_records(read_chunks(spark, path))
