from collections import defaultdict

from helpers import empty, messy
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomelight.llm import packing

LENGTHS = (16, 64, 128)


def brute(sizes, lengths):
    """Best fit by trying every open bin."""
    bins, placed, rest = [], [], sum(sizes)
    for size in sizes:
        fits = [(room, b) for b, (room, _) in enumerate(bins) if room >= size]
        if fits:
            _, b = min(fits)
        else:
            c = min((c for c in lengths if c >= size), key=lambda c: (packing.cost(c) / min(c, rest), c))
            b = len(bins)
            bins.append((c, 0))
        room, used = bins[b]
        bins[b] = (room - size, used + size)
        placed.append(b)
        rest -= size
    return placed, [min(c for c in lengths if c >= used) for _, used in bins]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 128), max_size=80))
def test_pack_against_brute_force(sizes):
    sizes = sorted(sizes, reverse=True)
    placed, offsets, capacity = packing.pack(sizes, LENGTHS)
    assert (placed, capacity) == brute(sizes, LENGTHS)
    held = defaultdict(int)
    for b, o, s in zip(placed, offsets, sizes, strict=True):
        assert o == held[b]
        held[b] += s


def check(rows, expected, lengths):
    """Every token of every document stands in one place, and no bin is larger than it must be."""
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append((r.offset, r.n_tokens, r.capacity))
        docs[r.doc_id].append((r.start, r.n_tokens))
    for held in bins.values():
        at = 0
        for offset, n, _ in sorted(held):
            assert offset == at
            at += n
        assert {c for _, _, c in held} == {min(c for c in lengths if c >= at)}
    assert {d: sum(n for _, n in p) for d, p in docs.items()} == expected


def test_documents(spark):
    sizes = {i: (i * 37) % 300 + 1 for i in range(400)}
    df = spark.createDataFrame([(i, f"text {i}", n) for i, n in sizes.items()], "doc_id long, text string, n long")
    out = packing.pack_documents(df, F.col("n"), LENGTHS, shard_pieces=100)
    check(out.collect(), sizes, LENGTHS)
    made = packing.sequences(out)
    assert made.agg(F.sum("n_tokens")).first()[0] == sum(sizes.values())


def test_messy_rows(spark):
    df = messy(spark)
    counts = {}
    for id, n in df.select("doc_id", packing.count_units(F.col("text"))).collect():
        counts[id] = counts.get(id, 0) + n
    assert counts[1] == counts[2] == 1 and counts[3] == 3 and counts[5] == 32001
    check(packing.pack_documents(df).collect(), counts, packing.LENGTHS)
    assert packing.pack_documents(empty(spark)).collect() == []
