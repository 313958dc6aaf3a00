"""Ranked lexical search with hashed max-sketches.

The index holds a row per document: its length and its distinct terms as 64-bit hashes with
their counts. A query set meets it block of queries by block of queries. In a task a run of
documents becomes sketches: the impacts of a document's terms, folded into ``SKETCH``
coordinates by hash, each coordinate keeping the largest. Looking the terms of all
queries up in the sketches gives what a document can score at most. For each query the
documents are scored exactly in descending order of that bound until it falls below the
lowest of the best k so far, so every document that can rank is scored and no other
needs to be. A task emits its best k per query; two cuts by Spark leave the best of all.

Scores are integers: a term weighs floor(1000 ln((2N + 2) / (2 df + 1))), its impact in a
document of n terms is 10^9 tf div (1000 tf + 20 m) with m = 50 + (50 n N) div L.

Defined results: a null, empty or blank text has no terms and is not counted in N; rows
with a null doc_id or item_id take no part; rows that share a doc_id are ranked each; rows that share an
item_id are one query with the terms of all; equal scores go by doc_id; queries without
terms find nothing; other columns are ignored. Terms whose 64-bit hashes are equal count as one
(for 10^4 query terms and 10^9 corpus terms that happens once in a million corpora).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import materialize

BEST = 50
SKETCH = 4096
#: Queries that meet the index together, documents of one run, documents scored at a time.
QUERY_BLOCK, RUN, STEP = 512, 1024, 64
#: Terms whose hashes a Python worker remembers, and bytes of text split at a time.
CACHE_TERMS = 500_000
BATCH_BYTES = 4_000_000
#: First-level groups of the final cut.
CUTS = 256
#: Terms are runs of ASCII letters, digits and all bytes above ASCII; the rest separates.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class TermHashes(dict):
    """Hashes of terms, remembered up to a bound."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > CACHE_TERMS:
            self.clear()
        self[term] = found = xxhash.xxh64_intdigest(term)
        return found


term_hashes = TermHashes()


def terms_of(text: str) -> np.ndarray:
    """Hashes of the terms of a text, in order."""
    found = text.encode().translate(FOLD).split()
    return np.fromiter(map(term_hashes.__getitem__, found), np.uint64, len(found)).view(np.int64)


def index(docs: DataFrame) -> DataFrame:
    """doc_id, n (all terms), terms (sorted hashes) and tfs of every document that has an id."""

    def made(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                bags = [np.unique(terms_of(t.as_py()), return_counts=True) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                        pa.array([t for t, _ in bags], pa.list_(pa.int64())),
                        pa.array([c.astype(np.int32) for _, c in bags], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.filter("doc_id IS NOT NULL")
    return rows.mapInArrow(made, "doc_id long, n long, terms array<long>, tfs array<int>")


@dataclass
class Queries:
    """A block of queries: ids, all their terms in order, and per query the places of its terms."""

    ids: list[int]
    terms: np.ndarray
    places: list[np.ndarray]


def query_blocks(items: DataFrame, size: int = QUERY_BLOCK):
    """The query set in blocks; one block at a time is in the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.filter("item_id IS NOT NULL").orderBy("item_id", "text")
    each = groupby(rows.toLocalIterator(), lambda r: r["item_id"])
    bags = ((i, np.unique(np.concatenate([terms_of(r["text"]) for r in same]))) for i, same in each)
    block: list = []
    for bag in bags:
        block.append(bag)
        if len(block) == size:
            yield queries_of(block)
            block = []
    if block:
        yield queries_of(block)


def queries_of(bags: list[tuple[int, np.ndarray]]) -> Queries:
    terms = np.unique(np.concatenate([b for _, b in bags]))
    return Queries([i for i, _ in bags], terms, [np.searchsorted(terms, b) for _, b in bags])


def found_in(terms: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` are among the sorted ``known``, and their places there."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    hit = np.flatnonzero(known[at] == terms)
    return hit, at[hit]


def frequencies(indexed: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of the terms occurs."""

    def counted(batches):
        sums = np.zeros(len(terms), np.int64)
        for batch in batches:
            _, places = found_in(batch.column("terms").flatten().to_numpy(), terms)
            sums += np.bincount(places, minlength=len(terms))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], ["at", "n"])

    rows = indexed.select("terms").mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(len(terms), np.int64)
    for r in rows.collect():
        out[r["at"]] = r["n"]
    return out


def impacts(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impacts of terms that occur ``tfs`` times in documents of ``lengths`` terms."""
    # 50 n N passes 63 bits only where n N does so for a corpus of 10^17 terms.
    m = 50 + 50 * lengths * n_docs // max(n_terms, 1)
    return 1_000_000_000 * tfs // (1000 * tfs + 20 * m)


@dataclass
class Ranking:
    """The best documents of one query so far."""

    scores: np.ndarray
    ids: np.ndarray
    lowest: int = 1

    def add(self, scores: np.ndarray, ids: np.ndarray, k: int) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == k:
            self.lowest = int(self.scores[-1])


class Searcher:
    """Meets runs of documents with a block of queries; keeps the best of each query."""

    def __init__(self, queries: Queries, df: np.ndarray, n_docs: int, n_terms: int, k: int, sketch: int):
        self.queries, self.n_docs, self.n_terms, self.k, self.sketch = queries, n_docs, n_terms, k, sketch
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
        # A term that no document has adds nothing.
        self.weight = np.where(df > 0, np.array(weight, np.int64), 0)
        self.places = [p[self.weight[p] > 0] for p in queries.places]
        owner = np.repeat(np.arange(len(self.places)), [len(p) for p in self.places])
        place = np.concatenate(self.places)
        coordinate = self.fold(queries.terms)[place]
        order = np.argsort(coordinate, kind="stable")
        # Lookup lists by coordinate: which queries ask for it, with what weight.
        self.asked_by, self.asks = owner[order], self.weight[place][order].astype(float)
        self.list_ends = np.searchsorted(coordinate[order], np.arange(sketch + 1))
        self.best = [Ranking(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.ids]

    def fold(self, terms: np.ndarray) -> np.ndarray:
        return (terms.view(np.uint64) % np.uint64(self.sketch)).astype(np.int64)

    def bounds(self, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray, n: int) -> np.ndarray:
        """What each of ``n`` documents can score for each query at most."""
        cell = docs * self.sketch + self.fold(terms)
        order = np.lexsort((impact, cell))
        cell, impact = cell[order], impact[order]
        last = np.flatnonzero(np.concatenate([cell[1:] != cell[:-1], [True]])) if len(cell) else order
        cell, impact = cell[last], impact[last]
        start = self.list_ends[cell % self.sketch]
        size = self.list_ends[cell % self.sketch + 1] - start
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        slot = np.repeat(cell // self.sketch, size) * len(self.best) + self.asked_by[at]
        sums = np.bincount(slot, self.asks[at] * np.repeat(impact, size), n * len(self.best))
        # Whole numbers below 2^53 add up exactly; the margin is for larger ones.
        return sums.reshape(n, -1) * (1 + 1e-9)

    def meet(self, ids: np.ndarray, ends: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        docs = np.repeat(np.arange(len(ids)), np.diff(ends))
        impact = impacts(tfs.astype(np.int64), lengths[docs], self.n_docs, self.n_terms)
        bounds = self.bounds(docs, terms, impact, len(ids))
        lowest = np.array([r.lowest for r in self.best])
        hopeful = bounds >= lowest[None, :]
        hit, place = found_in(terms, self.queries.terms)
        size = max(len(self.queries.terms), 1)
        # Both parts ascend, and so do the keys of the exact entries.
        keys, exact = docs[hit] * size + place, impact[hit]
        for q in np.flatnonzero(hopeful.any(axis=0)).tolist():
            rows = np.flatnonzero(hopeful[:, q])
            rows = rows[np.argsort(-bounds[rows, q], kind="stable")]
            own, ranking = self.places[q], self.best[q]
            for start in range(0, len(rows), STEP):
                some = rows[start : start + STEP]
                some = some[bounds[some, q] >= ranking.lowest]
                if not len(some):
                    break
                wanted = some[:, None] * size + own[None, :]
                at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
                held = np.where(keys[at] == wanted, exact[at], 0) if len(keys) else np.zeros(wanted.shape, np.int64)
                scores = held @ self.weight[own]
                keep = scores >= ranking.lowest
                ranking.add(scores[keep], ids[some][keep], self.k)

    def rows(self):
        for item, ranking in zip(self.queries.ids, self.best, strict=True):
            for doc, score in zip(ranking.ids.tolist(), ranking.scores.tolist(), strict=True):
                yield item, doc, score


def search_block(
    indexed: DataFrame, queries: Queries, n_docs: int, n_terms: int, k: int, sketch: int
) -> DataFrame:
    """item_id, doc_id, score: the best k of each task for each query."""
    df = frequencies(indexed, queries.terms)
    shape = [("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]

    def searched(batches):
        searcher = Searcher(queries, df, n_docs, n_terms, k, sketch)
        for batch in batches:
            for start in range(0, len(batch), RUN):
                part = batch.slice(start, RUN)
                lists = part.column("terms")
                ends = lists.offsets.to_numpy().astype(np.int64)
                searcher.meet(
                    part.column("doc_id").to_numpy(),
                    ends - ends[0],
                    part.column("n").to_numpy(),
                    lists.flatten().to_numpy(),
                    part.column("tfs").flatten().to_numpy(),
                )
        found = list(zip(*searcher.rows(), strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, (_, t) in zip(found, shape, strict=True)], [n for n, _ in shape])

    full = indexed.filter("n > 0").select("doc_id", "n", "terms", "tfs")
    return full.mapInArrow(searched, "item_id long, doc_id long, score long")


def search(indexed: DataFrame, items: DataFrame, k: int = BEST, sketch: int = SKETCH) -> DataFrame:
    """item_id, rank, doc_id, score of the best k documents of an index for each query."""
    n_docs, n_terms = indexed.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = [search_block(indexed, q, n_docs, n_terms, k, sketch) for q in query_blocks(items)]
    none = indexed.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    found = reduce(DataFrame.union, blocks, none)

    def cut(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy("item_id", *by).orderBy(F.desc("score"), "doc_id")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # One query has k rows from every task: cut by groups of tasks first.
    first = cut(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(CUTS))), "part")
    return cut(first.drop("part", "rank")).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, sketch: int = SKETCH) -> DataFrame:
    """Index all documents and rank them for every item."""
    return search(materialize(index(docs)), items, k, sketch)
