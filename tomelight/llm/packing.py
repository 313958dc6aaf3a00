"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Pieces are placed in order of falling
length, each into the open bin that it leaves the least room in; where none has room,
a bin is opened at the length that costs least for what it is expected to hold: its
cost over the tokens that it can hold of those still to come. When all pieces are
placed, every bin is downsized to the shortest permitted length that holds its
contents. A sequence has a fixed cost, one in proportion to its length and one to the
square of it (attention), so padding costs as much as text.

Pieces are dealt by a hash of their identity into shards of about ``SHARD_PIECES``,
which are packed on their own; a shard's table holds three numbers per piece. A
text longer than the longest sequence is cut into pieces of that length and a rest, so
nothing is dropped.

Defined results: null and empty texts have one token, the end mark; documents of
one length or one id are placed in order of their id and text hash; rows with a null
doc_id are packed like others; an empty table gives no bins. Other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence whatever its length, in tokens, and the length at which attention
#: costs as much as everything else.
SEQUENCE_COST = 128
ATTENTION_LENGTH = 8192
SHARD_PIECES = 20_000
UNIT = r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]+"

PLACED = "doc_id long, piece int, start long, n_tokens long, bin_id string, capacity int, offset long"


def count_units(text: Column) -> Column:
    """Words, digits and runs of signs, and the end mark: a tokenizer's first cut."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(UNIT)) + 1).cast("long")


def cost(length: float) -> float:
    return SEQUENCE_COST + length * (1 + length / ATTENTION_LENGTH)


def pack(sizes: list[int], lengths: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, sizes in falling order, and the capacity of each bin."""
    lengths = tuple(sorted(lengths))
    rest = sum(sizes)
    bins: list[int] = []  # tokens in each bin
    opened: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room, bin) of bins with room, ascending
    placed, offsets = [], []
    for size in sizes:
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            # What can still come is at most ``rest``; the bin holds that or is filled.
            fits = [c for c in lengths if c >= size]
            room = min(fits, key=lambda c: (cost(c) / min(c, rest), c))
            b = len(bins)
            bins.append(0)
            opened.append(room)
        placed.append(b)
        offsets.append(bins[b])
        bins[b] += size
        rest -= size
        if room > size:
            bisect.insort(rooms, (room - size, b))
    downsized = [next(c for c in lengths if c >= used) for used in bins]
    return placed, offsets, downsized


def pieces(docs: DataFrame, n_tokens: Column, longest: int) -> DataFrame:
    """doc_id, order (a hash for ties), piece, start and n_tokens; texts over ``longest`` are cut."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("order"), n_tokens.alias("n")
    )
    last = F.floor((F.greatest("n", F.lit(1)) - 1) / longest).cast("int")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * longest
    return cut.select(
        "doc_id", "order", "piece", start.alias("start"),
        F.least(F.col("n") - start, F.lit(longest)).cast("long").alias("n_tokens"),
    )


def pack_documents(
    docs: DataFrame,
    n_tokens: Column | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece of a document: its bin, the bin's length, and its place in it.

    ``n_tokens`` is the length of a text in tokens, by default its units. ``start``
    is where the piece begins in its document, ``offset`` where in its bin.
    """
    counted = count_units(F.col("text")) if n_tokens is None else n_tokens
    cut = pieces(docs, counted, max(lengths))
    shards = max(1, -(-docs.count() // shard_pieces))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "order", "piece"), F.lit(shards)).cast("int"))

    def pack_shard(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("n_tokens", "descending"), ("doc_id", "ascending"), ("order", "ascending"), ("piece", "ascending")]
        )
        placed, offsets, capacity = pack(table.column("n_tokens").to_pylist(), lengths)
        shard = key[0].as_py()
        return pa.table(
            [
                *(table.column(c) for c in ("doc_id", "piece", "start", "n_tokens")),
                pa.array([f"{shard}-{b}" for b in placed], pa.string()),
                pa.array(np.array(capacity, np.int32)[placed], pa.int32()),
                pa.array(offsets, pa.int64()),
            ],
            ["doc_id", "piece", "start", "n_tokens", "bin_id", "capacity", "offset"],
        )

    return dealt.groupBy("shard").applyInArrow(pack_shard, PLACED)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per bin: its length, its tokens, and what it holds, in order."""
    items = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "n_tokens")))
    return placed.groupBy("bin_id").agg(
        F.first("capacity").alias("capacity"), F.sum("n_tokens").alias("n_tokens"), items.alias("items")
    )
