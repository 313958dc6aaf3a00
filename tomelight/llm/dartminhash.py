"""Near-duplicate documents by DartMinHash over weighted word shingles.

A document is the bag of its five-word shingles. Darts are thrown, by hash, into the
regions that lie under each shingle's weight: the region of weights [2^(v-1), 2^v) is
as wide as that and receives a Poisson stream of darts in order of rank, each with a
weight and a coordinate. A document's darts are those whose weight it reaches; as
many ranks are opened as fill every coordinate, and the earliest dart of each coordinate
is its value. Two documents agree in a coordinate with the probability of their
weighted Jaccard similarity, and only about k log k darts are looked at, however long
the text.

``BANDS`` bands of ``ROWS`` values give candidates (a pair of similarity 0.8 is missed
with probability (1 - 0.8^4)^24 = 3e-6), which are verified by the exact weighted Jaccard
similarity of their shingles. Equal texts are one vertex. In a bucket every member
is first compared with one leader only, the member that shares buckets with most
others, so a group of copies yields one link per member and not all pairs. Where a
bucket's members are then still in different components, those documents are joined
exactly: a pair of the similarity shares a shingle among the rarest of either (prefix
filter) with enough others behind it (positional filter), and a shingle held by one
component alone makes no pair. What passes is verified too. Classes are the components of all links, so no link between different
texts is lost beyond that bound.

Defined results: texts count as equal when their words are equal in lower case (texts
without words: when equal as they are; null counts as empty); a text of fewer than five
words has one shingle of all its words; rows with a null doc_id belong to no class
(class_id null); rows that share a doc_id share its class; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Letters and digits of any script.
WORD = re.compile(r"[^\W_]+")
#: Words whose hashes a Python worker remembers; shingles whose darts are thrown together.
CACHE_WORDS = 500_000
BATCH_SHINGLES = 400_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / 2**53


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


word_hashes = WordHashes()


def words_of(text: str) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    words = WORD.findall(text.lower())
    return np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a word sequence as sorted hashes, and how often each occurs."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, np.uint64(n))
    for j in range(n):
        out = mix(out * GOLDEN + words[j : len(words) - n + 1 + j])
    return np.unique(out, return_counts=True)


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int) -> np.ndarray:
    """The ``k`` DartMinHash values of each of several weighted sets, none of them empty.

    ``owner`` says which set (0 to ``sets`` - 1) an element belongs to.
    """
    # One cell for each element and weight region that its weight reaches into.
    levels = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))), 0).astype(np.int64) + 1
    of = np.repeat(np.arange(len(elements)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    width = np.where(level > 0, low, 1.0)
    key = mix(elements[of] + GOLDEN * (level + 1).astype(np.uint64))
    top, own = weights[of].astype(np.float64), owner[of]

    def gap(cells: np.ndarray, nth: np.ndarray) -> np.ndarray:
        return -np.log(uniform(mix(key[cells] + GOLDEN * (2 * nth + np.uint64(1))))) / width[cells]

    count = np.zeros(len(key), np.uint64)
    rank = gap(np.arange(len(key)), count)
    until = (k * np.log(k) + 2 * k) / np.bincount(owner, weights, sets)
    best, value = np.full(sets * k, np.inf), np.zeros(sets * k, np.uint64)
    while True:
        live = np.flatnonzero(rank < until[own])
        darts = []
        while len(live):
            dart = mix(key[live] + GOLDEN * (2 * count[live] + np.uint64(2)))
            under = low[live] + uniform(mix(dart + GOLDEN)) * width[live] <= top[live]
            hit, name = live[under], dart[under]
            darts.append((own[hit] * k + (name % np.uint64(k)).astype(np.int64), rank[hit], name))
            count[live] += np.uint64(1)
            rank[live] += gap(live, count[live])
            live = live[rank[live] < until[own[live]]]
        if darts:
            slot, at, name = (np.concatenate(x) for x in zip(*darts, strict=True))
            order = np.lexsort((at, slot))
            first = order[np.unique(slot[order], return_index=True)[1]]
            first = first[at[first] < best[slot[first]]]
            best[slot[first]], value[slot[first]] = at[first], name[first]
        short = ~np.isfinite(best).reshape(sets, k).all(axis=1)
        if not short.any():
            return value.reshape(sets, k)
        until = np.where(short, until * 2, 0.0)


def bands_of(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket number per set and band."""
    out = mix(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN)
    for j in range(rows):
        out = mix(out + values.reshape(-1, bands, rows)[:, :, j])
    return out.view(np.int64)


def buckets_of(bags: list, bands: int, rows: int) -> list[np.ndarray]:
    """The buckets of each bag of shingles (hashes, counts); none of an empty one."""
    out = [np.zeros(0, np.int64)] * len(bags)
    full = [i for i, (h, _) in enumerate(bags) if len(h)]
    while full:
        sizes = np.cumsum([len(bags[i][0]) for i in full])
        n = max(1, int(np.searchsorted(sizes, BATCH_SHINGLES, "right")))
        part, full = full[:n], full[n:]
        owner = np.repeat(np.arange(n), [len(bags[i][0]) for i in part])
        elements, weights = (np.concatenate([bags[i][x] for i in part]) for x in (0, 1))
        values = throw(elements, weights, owner, n, bands * rows)
        for i, found in zip(part, bands_of(values, bands, rows), strict=True):
            out[i] = found
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (equal for equal word sequences) and buckets, one per band."""

    def signed(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                keys, bags = [], []
                for text in part.column("text").to_pylist():
                    words = words_of(text)
                    keys.append(
                        xxhash.xxh3_128_hexdigest(words.tobytes())
                        if len(words)
                        else "=" + xxhash.xxh3_128_hexdigest(text)
                    )
                    bags.append(shingles(words, shingle))
                buckets = buckets_of(bags, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys, pa.string()), pa.array(buckets, pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "buckets"],
                )

    rows_in = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows_in.mapInArrow(signed, "doc_id long, text_key string, buckets array<long>")


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id with its shingle hashes (sorted), their counts, and the sum of these."""

    def made(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                found = [shingles(words_of(t), shingle) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64())),
                        pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32())),
                        pa.array([int(n.sum()) for _, n in found], pa.int64()),
                    ],
                    ["doc_id", "hashes", "counts", "total"],
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(made, "doc_id long, hashes array<long>, counts array<int>, total long")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches ``similarity``."""

    def weigh(batches):
        for batch in batches:
            columns = {
                n: (batch.column(n).offsets.to_numpy(), batch.column(n).values.to_numpy(zero_copy_only=False))
                for n in ("ha", "ca", "hb", "cb")
            }
            keep = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                ha, ca, hb, cb = (v[o[i] : o[i + 1]] for o, v in columns.values())
                _, x, y = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
                shared = int(np.minimum(ca[x], cb[y]).sum())
                total = int(ca.sum()) + int(cb.sum()) - shared
                keep[i] = shared >= similarity * total - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"), F.col("counts").alias("ca"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"), F.col("counts").alias("cb"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", "ha", "ca", "hb", "cb"
    ).mapInArrow(weigh, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each linked node's component.

    Every round hooks each node to its smallest neighbour and contracts; tables are
    written between rounds. Only nodes that have links appear.
    """
    links = materialize(links.select("a", "b").filter("a <> b").distinct())
    both = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = materialize(both.withColumn("label", F.col("node")))
    while not links.isEmpty():
        around = links.union(links.select("b", "a"))
        hook = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        # Two hooks at once: to the smallest neighbour's smallest neighbour.
        hook = materialize(hook)
        onward = hook.select(F.col("a").alias("to"), F.col("to").alias("next"))
        hook = materialize(hook.join(onward, "to").select("a", F.least("to", "next").alias("to")))
        labels = materialize(
            labels.join(hook, labels["label"] == hook["a"], "left").select(
                "node", F.coalesce("to", "label").alias("label")
            )
        )
        left = hook.select("a", F.col("to").alias("x"))
        right = hook.select(F.col("a").alias("b"), F.col("to").alias("y"))
        links = materialize(
            links.join(left, "a").join(right, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    return labels


def across(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b) of documents in different components, exact.

    ``placed`` has doc_id and label. A shingle that occurs c times is c elements.
    """
    counted = sets.join(placed, "doc_id").select(
        "doc_id", "label", "total", F.explode(F.arrays_zip("hashes", "counts")).alias("s")
    )
    copies = counted.select(
        "doc_id", "label", "total", "s.hashes", F.explode(F.sequence(F.lit(1), "s.counts")).alias("nth")
    )
    each = copies.select("doc_id", "label", "total", F.xxhash64("hashes", "nth").alias("element"))
    # What is known of an element is added where its rows lie, without a join of the rows with themselves.
    held = Window.partitionBy("element")
    shared = each.select(
        "*",
        F.count(F.lit(1)).over(held).alias("df"),
        (F.min("label").over(held) < F.max("label").over(held)).alias("mixed"),
    ).filter("df > 1")
    mine = Window.partitionBy("doc_id")
    ranked = shared.withColumn("rank", F.row_number().over(mine.orderBy("df", "element"))).withColumn(
        "alone", F.col("total") - F.count(F.lit(1)).over(mine)
    )
    # Of a pair, the smaller side (by size, then id) shares a shingle early enough that all
    # the overlap a pair of its own size needs can follow; the larger one within its prefix.
    place = (F.col("alone") + F.col("rank")).alias("place")
    half = similarity / (1 + similarity)

    def prefix(share: float) -> Column:
        return F.col("total") - F.ceil(F.col("total") * share - 1e-9) + 1

    rare = materialize(
        ranked.filter("mixed").select("element", "doc_id", "label", "total", place)
        .filter(F.col("place") <= prefix(similarity))
    )
    left = rare.filter(F.col("place") <= prefix(2 * half)).select(
        "element", *(F.col(c).alias(f"{c}_a") for c in ("doc_id", "label", "total", "place"))
    )
    right = rare.select("element", *(F.col(c).alias(f"{c}_b") for c in ("doc_id", "label", "total", "place")))
    smaller = F.struct("total_a", "doc_id_a") < F.struct(F.col("total_b"), F.col("doc_id_b"))
    can_follow = F.least(F.col("total_a") - F.col("place_a"), F.col("total_b") - F.col("place_b")) + 1
    fits = (F.col("total_a") >= similarity * F.col("total_b") - 1e-9) & (
        can_follow >= half * (F.col("total_a") + F.col("total_b")) - 1e-9
    )
    pairs = left.join(right, "element").filter(smaller & (F.col("label_a") != F.col("label_b")) & fits)
    return pairs.select(
        F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")
    ).distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY, **options) -> DataFrame:
    """doc_id and class_id, the smallest doc_id among its near copies; a row per document."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = given.filter("doc_id IS NOT NULL")
    signed = materialize(signatures(known, **options))
    firsts = signed.groupBy("text_key").agg(F.min("doc_id").alias("first"))
    keys = signed.select("doc_id", "text_key").distinct()
    copies = materialize(keys.join(firsts, "text_key").select("doc_id", "first"))

    # A document's buckets are entered once, under the smallest document of equal text.
    entered = (
        signed.join(copies.filter("doc_id = first").distinct(), "doc_id")
        .select(F.col("first").alias("doc"), F.explode("buckets").alias("bucket"))
    )
    sizes = entered.groupBy("bucket").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("size")
    )
    members = materialize(
        entered.join(sizes.filter("low < high").select("bucket", "size"), "bucket").distinct()
    )
    degrees = materialize(members.groupBy("doc").agg(F.sum("size").alias("degree")))
    known_degrees = members.join(degrees, "doc")
    leaders = known_degrees.groupBy("bucket").agg(F.max_by("doc", "degree").alias("leader"))
    members = materialize(members.join(leaders, "bucket").select("bucket", "doc", "leader"))
    involved = degrees.select(F.col("doc").alias("doc_id"))
    # Rows that share a doc_id may differ in text; the greatest text stands for them.
    texts = known.join(involved, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
    sets = materialize(shingle_sets(texts))

    star = members.filter("doc <> leader").select(
        F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")
    )
    links = materialize(verified(materialize(star.distinct()), sets, similarity))
    labels = components(links)

    # Members of one bucket whose components differ have not all been compared yet.
    placed = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
        "bucket", "doc", F.coalesce("label", "doc").alias("label")
    )
    mixed = placed.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size")
    )
    mixed = mixed.filter("low < high AND size > 2").select("bucket")
    undecided = materialize(
        placed.join(mixed, "bucket").select(F.col("doc").alias("doc_id"), "label").distinct()
    )
    more = materialize(verified(across(undecided, sets, similarity), sets, similarity))
    if not more.isEmpty():
        labels = components(links.union(more))
    found = copies.join(labels.withColumnRenamed("node", "first"), "first", "left").select(
        "doc_id", F.coalesce("label", "first").alias("class_id")
    )
    # One id, one class, also where rows of different texts share the id.
    found = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return given.select("doc_id").join(found, "doc_id", "left")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, **options) -> DataFrame:
    """The documents that are the smallest of their class, with all their columns."""
    found = classes(docs, similarity, **options)
    kept = found.filter("doc_id = class_id").select("doc_id").distinct()
    whole = docs.select("doc_id", F.struct(*docs.columns).alias("_row"))
    named = whole.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("_row.text")
    first = named.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return first.select("_row.*").union(docs.filter("doc_id IS NULL"))
