"""Benchmark passages in documents, found by latent semantic retrieval.

Benchmark texts are cut into parts of at most ``PART`` words, the queries. Documents
are read as windows, one starting every ``BLOCK`` words, over their whole length. Both
are bags of terms weighted by TF-IDF (log idf, no term left out), terms being words of
the benchmark (no other word can add to a query's similarity). A randomised SVD of all
queries and windows of ``2 * BLOCK`` words is made in one distributed pass: each task
adds up A'(A X) for its windows, A being the weighted windows and X a random matrix,
and the sums are orthogonalised.

Candidates come from two routes. The latent one takes the windows whose cosine with a query
in the ``RANK`` directions reaches ``COSINE``. The lexical one loses nothing: a confirmed passage
leaves out at most n - need of a query's n words, so of its n - need + c rarest words it holds
c, and every window with that many of them (c is half of need) is a candidate, whichever words of a passage are
replaced. A window of the lexical route is long enough to hold every stretch that starts in
its first block.

A candidate must hold as many of the query's words as it needs and is confirmed by the longest
common subsequence of the query's words and the words of a stretch at most ``STRETCH`` times as long: at least ``COVERED`` of the query
and, where the benchmark has the column ``answer``, at least ``ANSWERED`` of the answer's words
in the part; parts without such words are decided by the query alone. Every stretch of
a candidate is compared.

Defined results: null and empty texts match nothing, a part of fewer than ``LEAST``
words is not a query, an empty benchmark finds nothing; matching ignores case and
punctuation; rows that share a doc_id or item_id are searched each and reported once
per pair of ids; other columns are ignored. :func:`keep_clean` decides every row by its own text (by the text's
64-bit hash), also where ids are null or repeated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import materialize

BLOCK, PART, LEAST = 24, 48, 5
RANK = 64
#: Cosine of the latent route.
COSINE = 0.7
#: Queries that meet the windows in one job, and at a time in a task.
QUERY_PARTS, PART_RUN = 4096, 512
COVERED, STRETCH, ANSWERED = 0.7, 1.5, 0.5
WORD = re.compile(r"\w+")
#: Term rows that travel together in the sums of the sketch, and their first-level groups.
SUM_ROWS, SUM_GROUPS = 256, 64
#: Rarest words of a query that are looked up in a window before all of them are.
FIRST = PART // 3


def words(text: str | None) -> list[str]:
    # Faster than a pattern that leaves out underscores.
    return WORD.findall((text or "").lower().replace("_", " "))


@dataclass
class Queries:
    """Benchmark parts as term numbers, and the terms."""

    terms: dict[str, int]
    parts: list[np.ndarray]
    items: list[int]
    answers: list[int]


def read_queries(benchmark: DataFrame) -> Queries:
    """The stated query set. It is brought to the driver whole; corpora are not."""
    has_answer = "answer" in benchmark.columns
    rows = benchmark.select("item_id", "text", *(["answer"] if has_answer else [])).distinct().collect()
    found = Queries({}, [], [], [])
    for row in sorted(rows, key=lambda r: (str(r["item_id"]), r["text"] or "")):
        asked, answer = words(row["text"]), words(row["answer"]) if has_answer else []
        whole = asked + answer
        ids = np.array([found.terms.setdefault(w, len(found.terms)) for w in whole], np.int32)
        n = -(-len(ids) // PART)
        for i in range(n):
            part = ids[i * len(ids) // n : (i + 1) * len(ids) // n]
            if len(part) >= LEAST and row["item_id"] is not None:
                found.parts.append(part)
                found.items.append(row["item_id"])
                found.answers.append(min(max((i + 1) * len(ids) // n - len(asked), 0), len(part)))
    return found


def encode(docs: DataFrame, terms: dict[str, int]) -> DataFrame:
    """doc_id and each word's term number, -1 for words that no query has."""

    def coded(batches):
        get = terms.get
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                ids, ends = [], [0]
                for text in part.column("text").to_pylist():
                    ids += map(get, words(text))
                    ends.append(len(ids))
                flat = pa.array(ids, pa.int32()).fill_null(-1)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(coded, "doc_id long, ids array<int>")


def lists(batch: pa.RecordBatch, size: int = 1_000_000):
    """Runs of documents of about ``size`` words: first row, ends of documents, flat term numbers."""
    column = batch.column("ids")
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    start = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + size, "right")) - 1)
        yield start, ends[start : stop + 1] - ends[start], flat[ends[start] : ends[stop]]
        start = stop


def frequencies(coded: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """How often each term occurs, and the number of all words."""

    def counted(batches):
        sums = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for _, _, flat in lists(batch):
                sums += np.bincount(flat + 1, minlength=n_terms + 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at - 1), pa.array(sums[at])], ["term", "n"])

    rows = coded.select("ids").mapInArrow(counted, "term long, n long")
    found = rows.groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n_terms + 1, np.int64)
    for r in found:
        out[r["term"] + 1] = r["n"]
    return out[1:], int(out.sum())


def weigh(counts: np.ndarray, total: int) -> np.ndarray:
    """Weights of terms: log idf; all are above 0."""
    return np.log1p((total + 1.0) / (counts + 1.0)).astype(np.float32)


def needed(part: np.ndarray) -> int:
    """The words of a query that a passage must hold."""
    return int(np.ceil(COVERED * len(part) - 1e-9))


def window_entries(ends: np.ndarray, flat: np.ndarray, weight: np.ndarray):
    """Weighted terms of a run of documents with the block each stands in, and the blocks.

    Blocks of all documents are numbered on; ``after`` says whether a block's successor
    belongs to the same document.
    """
    sizes = np.diff(ends)
    blocks = -(-sizes // BLOCK)
    first = np.cumsum(blocks) - blocks
    at = np.flatnonzero((flat >= 0) & (weight[flat] > 0))
    doc = np.searchsorted(ends, at, "right") - 1
    block = first[doc] + (at - ends[doc]) // BLOCK
    of = np.repeat(np.arange(len(sizes)), blocks)
    after = np.concatenate([of[1:] == of[:-1], [False]]) if len(of) else np.zeros(0, bool)
    return flat[at], block, of, first, after


def summed(table: np.ndarray, columns: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the named columns of ``table`` by ascending ``owner``, one column each; zeros where there are none.

    Columns rather than rows: a coordinate's sums then run over neighbouring numbers.
    """
    out = np.zeros((len(table), n), np.float32)
    if len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        at, columns = owner[starts], columns.astype(np.intp, copy=False)
        for line, sums in zip(table, out, strict=True):
            sums[at] = np.add.reduceat(line[columns], starts)
    return out


def sketch(coded: DataFrame, weight: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """A'(A X) summed over all windows of all documents; X is random."""
    n_terms = len(weight)
    random = np.random.default_rng(seed).standard_normal((n_terms, rank)).astype(np.float32)
    schema = pa.schema([("part", pa.int32()), ("salt", pa.int32()), ("data", pa.binary())])

    def added(batches):
        total = np.zeros((rank, n_terms), np.float32)
        weighted = np.ascontiguousarray((random * weight[:, None]).T)
        for batch in batches:
            for _, ends, flat in lists(batch, 200_000):
                terms, block, of, _, after = window_entries(ends, flat, weight)
                own = summed(weighted, terms, block, len(of))
                # A window is a block and the one after it: each block is part of two.
                window = own.copy()
                window[:, :-1] += own[:, 1:] * after[:-1]
                both = window.copy()
                both[:, 1:] += window[:, :-1] * after[:-1]
                order = np.argsort(terms, kind="stable")
                total += summed(both, block[order], terms[order], n_terms)
        total = np.ascontiguousarray(total.T) * weight[:, None]
        salt = int(np.abs(total[:, 0]).sum() * 1e6) % SUM_GROUPS
        for start in range(0, n_terms, SUM_ROWS):
            row = (start // SUM_ROWS, salt, total[start : start + SUM_ROWS].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema
            )

    def sum_up(table: pa.Table) -> pa.Table:
        arrays = (np.frombuffer(b.as_buffer(), np.float32) for b in table.column("data").combine_chunks())
        total = next(arrays).copy()
        for x in arrays:
            total += x
        first = [table.column(c)[0].as_py() for c in ("part", "salt")]
        return pa.table([pa.array([v], t) for v, t in zip([*first, total.tobytes()], schema.types, strict=True)], schema=schema)

    shape = "part int, salt int, data binary"
    rows = coded.select("ids").mapInArrow(added, shape)
    rows = rows.groupBy("part", "salt").applyInArrow(sum_up, shape)
    rows = rows.groupBy("part").applyInArrow(sum_up, shape).collect()
    out = np.zeros((n_terms, rank), np.float32)
    for r in rows:
        got = np.frombuffer(bytes(r["data"]), np.float32).reshape(-1, rank)
        out[r["part"] * SUM_ROWS : r["part"] * SUM_ROWS + len(got)] = got
    return out


def latent_space(coded: DataFrame, queries: Queries, weight: np.ndarray, rank: int):
    """Latent vectors of terms (weighted) and of queries."""
    rank = min(rank, len(weight))
    total = sketch(coded, weight, rank)
    random = np.random.default_rng(7).standard_normal((len(weight), rank)).astype(np.float32)
    for part in queries.parts:
        np.add.at(total, part, np.outer(weight[part], weight[part] @ random[part]))
    space = np.linalg.qr(total.astype(np.float64))[0].astype(np.float32) * weight[:, None]
    return space, np.array([space[part].sum(axis=0) for part in queries.parts])


def rarest(part: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The rarest words of a query, and how many of them a passage holds at least."""
    need = needed(part)
    least = -(-need // 2)
    return part[np.lexsort((part, counts[part]))][: len(part) - need + least], least


def subsequence(query: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Length of the longest common subsequence and the shortest stretch of ``text`` found for it.

    Cells hold length and latest possible start as one number, the length above it.
    """
    m = len(text)
    one = m + 1
    row = np.zeros(m + 1, np.int64)
    places = np.arange(m)
    for word in query:
        began = np.where(row[:-1] >= one, row[:-1], places) + one
        hit = np.where(text == word, began, 0)
        row[1:] = np.maximum(row[1:], hit)
        row = np.maximum.accumulate(row)
    best = int(row[-1]) // one
    if not best:
        return 0, 0, 0
    ends = np.flatnonzero(row // one == best)
    spans = ends - row[ends] % one
    at = int(np.argmin(spans))
    return best, int(ends[at] - spans[at]), int(ends[at])


def longest_common(query: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``query`` and each row of ``texts``."""
    row = np.zeros((len(texts), texts.shape[1] + 1), np.int16)
    for word in query:
        np.maximum(row[:, 1:], np.where(texts == word, row[:, :-1] + 1, 0), out=row[:, 1:])
        np.maximum.accumulate(row, axis=1, out=row)
    return row[:, -1]


def confirm(query: np.ndarray, answer: int, text: np.ndarray) -> tuple[int, int, int] | None:
    """LCS length and place of the best stretch that starts in the first block of ``text``
    and satisfies all thresholds."""
    need, longest = needed(query), int(STRETCH * len(query))
    starts = np.flatnonzero(np.isin(text[:BLOCK], query))
    if not len(starts) or longest_common(query, text[None, :])[0] < need:
        return None
    padded = np.concatenate([text, np.full(longest, -1, text.dtype)])
    stretches = padded[starts[:, None] + np.arange(longest)]
    lengths = longest_common(query, stretches)
    for at in np.argsort(-lengths, kind="stable"):
        if lengths[at] < need:
            break
        if answer and longest_common(query[len(query) - answer :], stretches[at][None, :])[0] < ANSWERED * answer:
            continue
        matched, begin, end = subsequence(query, stretches[at])
        return matched, int(starts[at]) + begin, int(starts[at]) + end
    return None


def spanned(own: np.ndarray, of: np.ndarray, span: int) -> np.ndarray:
    """Sums of every block and the ``span - 1`` after it in its document (``of``)."""
    out = own.copy()
    for k in range(1, min(span, len(own))):
        out[:-k] += own[k:] * (of[k:] == of[:-k]).reshape(-1, *[1] * (own.ndim - 1))
    return out


class Candidates:
    """Pairs of a window and a query by both routes, for a run of blocks."""

    def __init__(self, parts: list[np.ndarray], counts: np.ndarray, space: np.ndarray, latent: np.ndarray, cosine: float, span: int):
        self.space, self.cosine, self.span, self.n = np.ascontiguousarray(space.T), cosine, span, len(parts)
        self.unit = (latent / np.maximum(np.linalg.norm(latent, axis=1), 1e-30)[:, None]).T.astype(np.float32)
        self.need = np.array([needed(part) for part in parts])
        # Words of queries, the rarest first, filled up with a term that no window has.
        self.filled = np.full((self.n, PART), len(counts), np.int32)
        rare, self.least = zip(*(rarest(part, counts) for part in parts), strict=True)
        for q, part in enumerate(parts):
            self.filled[q, : len(part)] = part[np.argsort(counts[part], kind="stable")]
        # Of the rarest ``FIRST`` words a window holds what the others cannot make up for.
        self.need_first = self.need - np.maximum([len(part) - FIRST for part in parts], 0)
        rare = [np.unique(words) for words in rare]
        term, query = np.concatenate(rare), np.repeat(np.arange(self.n), list(map(len, rare)))
        order = np.argsort(term, kind="stable")
        # The queries that a term is among the rarest of.
        self.asked, self.starts = query[order], np.searchsorted(term[order], np.arange(len(counts) + 1))
        self.least = np.array(self.least)

    def lexical(self, terms: np.ndarray, block: np.ndarray, of: np.ndarray) -> np.ndarray:
        size = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        cells = np.repeat(block, size) * self.n + self.asked[at]
        held = np.bincount(cells, minlength=len(of) * self.n).astype(np.int16).reshape(-1, self.n)
        return spanned(held, of, self.span) >= self.least

    def latent(self, terms: np.ndarray, block: np.ndarray, of: np.ndarray) -> np.ndarray:
        windows = spanned(np.ascontiguousarray(summed(self.space, terms, block, len(of)).T), of, 2)
        lengths = np.linalg.norm(windows, axis=1)
        return windows @ self.unit >= self.cosine * np.where(lengths > 0, lengths, np.inf)[:, None]

    def pairs(self, terms: np.ndarray, block: np.ndarray, of: np.ndarray, routes=("latent", "lexical")):
        """Windows and queries that meet by a route and have enough of the query's words in the window."""
        found = np.zeros((len(of), self.n), bool)
        for route in routes:
            found |= getattr(self, route)(terms, block, of)
        window, query = np.nonzero(found)
        present = np.zeros((len(of), self.space.shape[1] + 1), bool)
        for k in range(self.span):
            # A block's words are those of the windows that start up to ``span - 1`` blocks before it.
            at = np.flatnonzero((block >= k) & (of[np.maximum(block - k, 0)] == of[block]))
            present[block[at] - k, terms[at]] = True

        def enough(window: np.ndarray, query: np.ndarray, words: int, need: np.ndarray) -> np.ndarray:
            parts = [slice(i, i + 8192) for i in range(0, len(window), 8192)]
            keep = [np.count_nonzero(present[window[p, None], self.filled[query[p], :words]], axis=1) >= need[query[p]] for p in parts]
            return np.concatenate([*keep, np.zeros(0, bool)])

        for words, need in ((FIRST, self.need_first), (PART, self.need)):
            keep = enough(window, query, words, need)
            window, query = window[keep], query[keep]
        return window, query


def search(
    coded: DataFrame, queries: Queries, space: np.ndarray, latent: np.ndarray, counts: np.ndarray, cosine: float, routes=("latent", "lexical")
) -> DataFrame:
    """doc_id, item_id, matched, query_words, first_word for confirmed pairs, one row per part found."""
    span = -(-(int(STRETCH * max(len(part) for part in queries.parts)) + BLOCK - 1) // BLOCK)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int64()), ("query_words", pa.int64()), ("first_word", pa.int64())])
    weight = np.ones(len(counts), np.float32)

    def searched(batches):
        groups = []
        for start in range(0, len(queries.parts), PART_RUN):
            stop = start + PART_RUN
            groups.append((start, Candidates(queries.parts[start:stop], counts, space, latent[start:stop], cosine, span)))
        for batch in batches:
            ids = batch.column("doc_id")
            for row, ends, flat in lists(batch, 200_000):
                terms, block, of, first, _ = window_entries(ends, flat, weight)
                best = {}
                # Runs of blocks, each with the blocks that its last windows reach into.
                for s in range(0, len(of), 1024):
                    e = min(s + 1024 + span - 1, len(of))
                    a, z = np.searchsorted(block, [s, e])
                    for base, candidates in groups:
                        for window, q in zip(*candidates.pairs(terms[a:z], block[a:z] - s, of[s:e], routes), strict=True):
                            if window >= 1024:
                                continue
                            q, window = base + int(q), s + int(window)
                            doc = int(of[window])
                            low = (window - int(first[doc])) * BLOCK
                            text = flat[ends[doc] + low : min(ends[doc] + low + span * BLOCK, ends[doc + 1])]
                            hit = confirm(queries.parts[q], queries.answers[q], text)
                            if hit and hit[0] > best.get((doc, q), (0,))[0]:
                                best[doc, q] = (hit[0], low + hit[1])
                rows = [
                    (ids[row + doc].as_py(), queries.items[q], matched, len(queries.parts[q]), at)
                    for (doc, q), (matched, at) in best.items()
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
                    )

    return coded.mapInArrow(searched, NOTHING)


NOTHING = "doc_id long, item_id long, matched long, query_words long, first_word long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE, routes=("latent", "lexical")
) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains, with the best part's figures.

    ``routes`` names the ways to candidates; without the lexical one passages can be lost.
    """
    queries = read_queries(benchmark)
    if not queries.parts:
        return docs.sparkSession.createDataFrame([], NOTHING)
    coded = materialize(encode(docs, queries.terms))
    counts, total = frequencies(coded, len(queries.terms))
    weight = weigh(counts, total)
    space, latent = latent_space(coded, queries, weight, rank)
    jobs = []
    for start in range(0, len(queries.parts), QUERY_PARTS):
        some = slice(start, start + QUERY_PARTS)
        block = Queries(queries.terms, queries.parts[some], queries.items[some], queries.answers[some])
        jobs.append(search(coded, block, space, latent[some], counts, cosine, routes))
    found = reduce(DataFrame.union, jobs)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("matched").alias("matched"),
        F.max_by("query_words", "matched").alias("query_words"),
        F.min("first_word").alias("first_word"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    # Contamination is a matter of the text alone, so the text's hash stands for the row.
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64("text").alias("_text"))
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = contaminated(texts, benchmark, **options).select(F.col("doc_id").alias("_text")).distinct()
    return keyed.join(materialize(found), "_text", "left_anti").select("_row.*")
