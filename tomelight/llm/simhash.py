"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A document's fingerprint has 64 bits: bit i is 1 where more than half of the XXH64
hashes (seed 42) of its four-word shingles, repeats included, have it. Documents link where
their fingerprints differ in at most ``DISTANCE`` bits; a component is what links reach.

Four bits can spoil four of the eight bytes at most, so linked fingerprints share at least
four positional bytes. A list of all fingerprints with one given byte would hold a 256th of
the corpus, so an entry of the index holds three positions at once: of the 56 triples the
20 of a Turán system, which has a triple within every choice of four positions. Under each
entry the shared positional bytes of a pair are tallied, pairs that reach four are
retained, and these are verified by their differing bits.

Equal fingerprints are one vertex, so copies make no pairs. An entry that two fingerprints
share is decided by its least and greatest; one of up to ``GROUP`` fingerprints in one
task, which passes on links that span each component and not all pairs. For a larger
entry the pairs are found without meeting them: two fingerprints at most four bits
apart have a value in common that is at most two bits from either, so each is listed under
the 821 values that two bits of its other five bytes lead to, and links to the smallest
fingerprint of each such list. A list holds 821 fingerprints at most and no link is lost.

Defined results: null and empty texts and texts without words have fingerprint zero and
link like any other; rows that share a doc_id keep a fingerprint and component each;
rows with a null doc_id link like any other but name no component (it is null where all
rows of a component have no id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import is_small, salted_join
from ..sources.store import materialize
from .dartminhash import components

SHINGLE, SEED = 4, 42
DISTANCE = 4
#: Fingerprints of one index entry that are compared in one task.
GROUP = 4096
#: Entries whose list is broadcast, in rows of 24 bytes.
BROADCAST_ENTRIES = 500_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SLICE = 65536


def shingle_hashes(text: str) -> np.ndarray:
    """Hashes of the four-word shingles of a text; of all its words if they are fewer."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    n = min(SHINGLE, len(words))
    joined = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64, len(words) - n + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit, as a signed integer."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), SLICE):
        octets = hashes[start : start + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and bits, the fingerprint as a signed integer, of every row."""

    def made(batches):
        for batch in batches:
            bits = [fingerprint(shingle_hashes(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, pa.int64())], ["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(made, "doc_id long, bits long")


def triples() -> list[tuple[int, int, int]]:
    """Triples of byte positions with one inside every four: Turán's three-part system."""
    parts = [range(0, 3), range(3, 6), range(6, 8)]
    part = [next(p for p, own in enumerate(parts) if i in own) for i in range(8)]

    def chosen(triple) -> bool:
        counts = [sum(part[i] == p for i in triple) for p in range(3)]
        return 3 in counts or any(counts[p] == 2 and counts[(p + 1) % 3] == 1 for p in range(3))

    return [t for t in combinations(range(8), 3) if chosen(t)]


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def entries(vertices: DataFrame) -> DataFrame:
    """Rows (mask, octets, bits): a fingerprint under each of its index entries."""
    masks = [signed(sum(255 << 8 * i for i in t)) for t in triples()]
    rows = vertices.select("bits", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    return rows.select("mask", F.col("bits").bitwiseAND(F.col("mask")).alias("octets"), "bits")


def shared_octets(x: Column, y: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    differ = x.bitwiseXOR(y)
    same = [F.when(differ.bitwiseAND(F.lit(signed(255 << 8 * i))) == 0, 1).otherwise(0) for i in range(8)]
    return sum(same[1:], same[0])


def verified(pairs: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b) that share enough positional bytes, and of them those that link."""
    counted = pairs.filter(shared_octets(F.col("a"), F.col("b")) >= 8 - distance)
    return counted.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def spanning(bits: np.ndarray, distance: int, slab: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each component of the fingerprints of one entry."""
    n = len(bits)
    values = bits.view(np.uint64)
    label = np.arange(n)
    left, right = [], []
    ones = np.uint64(0x0101010101010101)
    for start in range(0, n, slab):
        differ = values[start : start + slab, None] ^ values[None, start:]
        # Fold each byte onto its lowest bit: what stays set is a byte not shared.
        folded = differ | differ >> np.uint64(4)
        folded |= folded >> np.uint64(2)
        folded |= folded >> np.uint64(1)
        retained = np.bitwise_count(folded & ones) <= distance
        retained &= np.bitwise_count(differ) <= distance
        x, y = np.nonzero(retained)
        for i, j in zip((x + start).tolist(), (y + start).tolist(), strict=True):
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
                left.append(i)
                right.append(j)
    return bits[left], bits[right]


def links_of_groups(members: DataFrame, distance: int) -> DataFrame:
    """Spanning links (a, b) of entries of at most ``GROUP`` fingerprints."""

    def met(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            # The last entry may go on in the next batch.
            rest, done = split_last(rest)
            yield from linked(done)
        if rest is not None:
            yield from linked(rest)

    def split_last(table):
        mask, octets = (table.column(c).to_numpy() for c in ("mask", "octets"))
        same = (mask == mask[-1]) & (octets == octets[-1])
        cut = len(same) - int(same.sum())
        return table.slice(cut), table.slice(0, cut)

    def linked(table):
        mask, octets, bits = (table.column(c).to_numpy() for c in ("mask", "octets", "bits"))
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (octets[1:] != octets[:-1])) + 1
        found = [spanning(part, distance) for part in np.split(bits, cuts) if len(part) > 1]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = members.repartition("mask", "octets").sortWithinPartitions("mask", "octets")
    return ordered.select("mask", "octets", "bits").mapInArrow(met, "a long, b long")


def links_of_large(members: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) of entries of any size, through values half the distance from either."""
    half = distance // 2
    flips = [sum(1 << i for i in c) for r in range(half + 1) for c in combinations(range(64), r)]
    near = members.select("mask", "bits", F.explode(F.array(*(F.lit(signed(f)) for f in flips))).alias("flip"))
    near = near.filter(F.col("flip").bitwiseAND(F.col("mask")) == 0)
    near = near.select("mask", "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("value"))
    least = near.groupBy("mask", "value").agg(F.min("bits").alias("a"), F.max("bits").alias("b"))
    pairs = near.join(least.filter("a < b"), ["mask", "value"]).select("a", F.col("bits").alias("b"))
    return pairs.filter("a <> b").distinct()


def links(vertices: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Links (a, b) between distinct fingerprints that reach whatever all links reach."""
    if distance % 2 or not 0 <= distance <= DISTANCE:
        raise ValueError("the index serves even distances up to 4")
    listed = entries(vertices)
    held = materialize(
        listed.groupBy("mask", "octets")
        .agg(F.count(F.lit(1)).alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b"))
        .filter("n > 1")
    )
    two = verified(held.filter("n = 2").select("a", "b"), distance)
    more = held.filter("n > 2").select("mask", "octets", "n")
    more = F.broadcast(more) if is_small(more, BROADCAST_ENTRIES) else more
    members = materialize(listed.join(more, ["mask", "octets"]))
    found = two.union(links_of_groups(members.filter(F.col("n") <= group), distance))
    found = found.union(links_of_large(members.filter(F.col("n") > group), distance))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(docs: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that
    links reach; a row per row of ``docs``."""
    rows = materialize(fingerprints(docs))
    vertices = materialize(
        rows.groupBy("bits").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    labels = components(links(vertices.select("bits"), distance, group))
    named = labels.withColumnRenamed("node", "bits")
    reached = vertices.join(named, "bits").groupBy("label").agg(F.min("first").alias("least"))
    linked = named.join(reached, "label").select("bits", "least")
    found = vertices.join(linked, "bits", "left")
    found = found.filter("copies > 1 OR least IS NOT NULL").select(
        "bits", F.coalesce("least", "first").alias("component_id")
    )
    joined = salted_join(rows, materialize(found), "bits", "doc_id")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))
