"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full content; a distinct text is tokenised and aligned once,
and what it adds to corpus counts is weighted by its copies. Tokenizer A (byte-level)
encodes a space and the text, tokenizer B (pieces) the text, to which it adds the space itself. Byte
offsets where tokens of both end cut a text into groups; an A and a B token whose byte ranges
overlap are a link.

A text is cut into units in front of single spaces between a visible character and a
letter or digit: there A starts a new word by its pattern and B has no piece that reaches
across (tested when the vocabulary is read), so groups and links of a text are those of
its units, which a task remembers. Texts of about ``CHUNK`` bytes form a chunk. A chunk
passes on how often it has each pair of ids, and the texts' units; the corpus-wide
counts of its own pairs come back to it by one join, so what moves grows with the distinct
pairs of the chunks and not with the links. Measures are joined to documents by the text's
SHA-256, hot texts in parts.

Defined results: null and empty texts, and texts whose tokens do not spell a space and
the text, have no tokens: zeros and an empty string; rows with a null doc_id count and
are returned with it; rows that share a doc_id are returned each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..sources.store import materialize
from .token_files import slices

#: Bytes of text of a chunk and of a slice; units and characters that a task remembers.
CHUNK, SLICE = 16_000_000, 1_000_000
CACHE_UNITS, CACHE_CHARS = 500_000, 30_000_000
CUT = re.compile("(?<=[^\\s▁]) (?=[A-Za-z0-9À-ÖØ-öø-ÿ])")
#: Units that may stand next to one another in a text, so that it is cut between them; how many are joined.
REGULAR = re.compile("[A-Za-z0-9À-ÖØ-öø-ÿ](?:.*[^\\s▁])?", re.DOTALL)
JOINED, TEXT_UNITS = 20_000, 500
#: How byte-level vocabularies write bytes: printable ones as themselves, others from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
CHARS = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("key", pa.binary()),
        *((name, pa.int64()) for name in COUNTS),
        ("groups_sha256", pa.string()),
        ("units", pa.binary()),
        ("link_ends", pa.list_(pa.int32())),
        ("links", pa.list_(pa.int32())),
        ("pair", pa.int64()),
        ("at", pa.int32()),
        ("n", pa.int64()),
    ]
)
ROW_SQL = (
    "chunk long, key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " units binary, link_ends array<int>, links array<int>, pair long, at int, n long"
)


class Tokenizers:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocab = self.a.get_vocab(with_added_tokens=True)
        entries = {i: bytes(CHARS.get(c, 0) for c in entry) for entry, i in vocab.items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        #: Whether texts may be cut at spaces: no piece has one behind another character.
        self.cut = not any("▁" in p.lstrip("▁") for p in pieces)

    def units(self, text: str) -> list[str]:
        return CUT.split(text) if self.cut else [text]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A of a space and the text, and by B of the text, of all texts one after the other."""
        found = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        a = np.concatenate([np.array(x.ids, np.int64) for x in found])
        return a, np.concatenate([np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)])

    def spell(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the tokens of both are a space and the text."""
        spelt = (" " + text).encode()
        return spelt == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ends of groups and of links of two spellings of the same bytes.

    Every stretch between two neighbouring ends of either spelling lies in one token of each, and a pair of
    tokens overlaps in one such stretch at most.
    """
    both = np.concatenate([a_ends, b_ends])
    both.sort(kind="stable")
    again = both[1:] == both[:-1]
    return both[1:][again], both[np.concatenate([[True], ~again])]


def spelled(a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray, names: list[str]) -> tuple[str, np.ndarray]:
    """Groups as text, each ``a,a|b,b;``, and the places where groups end there.

    ``a_upto`` and ``b_upto`` count the tokens up to each group's end; ``names`` are the ids as text.
    """
    a_size, b_size = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    a_at = np.arange(len(a)) + np.repeat(b_upto - b_size, a_size)
    b_at = np.arange(len(b)) + np.repeat(a_upto, b_size)
    ids = np.empty(len(a) + len(b), np.int64)
    ids[a_at], ids[b_at] = a, b
    signs = np.zeros(len(ids), np.int64)
    signs[a_at[a_upto - 1]], signs[b_at[b_upto - 1]] = 1, 2
    found = list(map(names.__getitem__, (ids * 3 + signs).tolist()))
    lengths = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    return "".join(found), lengths[b_at[b_upto - 1]]


class Units(dict):
    """Places of units; by place what is known of them. Unknown units wait for :meth:`learn`.

    Counts and links lie in pools, a unit's links one after the other as one number each.
    """

    def __init__(self, tokenizers: Tokenizers):
        super().__init__()
        self.tokenizers = tokenizers
        size = max(len(tokenizers.a_bytes), len(tokenizers.b_bytes))
        self.names = [f"{i}{sign}" for i in range(size) for sign in ",|;"]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.waiting: list[str] = []
        self.groups: list[str | None] = []
        #: By place, the row in the pools; by row, the counts, where the links start, and the links.
        self.rows, self.counts = array("q"), array("q")
        self.starts, self.links = array("q"), array("q")
        self.chars = 0

    def __missing__(self, unit: str) -> int:
        self[unit] = place = len(self)
        self.waiting.append(unit)
        return place

    def learn(self) -> None:
        """Tokenise and align the units that wait, joined to texts where they are regular."""
        new, self.waiting = self.waiting, []
        regular = [i for i, u in enumerate(new) if self.tokenizers.cut and REGULAR.fullmatch(u)]
        others = sorted(set(range(len(new))) - set(regular))
        rows, groups = np.zeros(len(new), np.int64), [None] * len(new)
        for some in [regular[i : i + JOINED] for i in range(0, len(regular), JOINED)] + [[i] for i in others]:
            rows[some] = len(self.starts) + np.arange(len(some))
            for i, text in zip(some, self.aligned([new[i] for i in some]), strict=True):
                groups[i] = text
        self.groups += groups
        self.rows.frombytes(rows.tobytes())
        self.chars += sum(map(len, new))

    def aligned(self, units: list[str]) -> list[str | None]:
        """Groups as text of units that follow one another in one text; fills the pools."""
        use = self.tokenizers
        texts = [" ".join(units[i : i + TEXT_UNITS]) for i in range(0, len(units), TEXT_UNITS)]
        a, b = use.encode(texts)
        if not use.spell(" ".join(texts), a, b):
            # Something in these units is not spelt; find out which.
            if len(units) > 1:
                return [text for u in units for text in self.aligned([u])]
            self.counts.extend([0] * len(COUNTS))
            self.starts.append(len(self.links))
            return [None]
        a_ends, b_ends = np.cumsum(use.a_sizes[a]), np.cumsum(use.b_sizes[b])
        group_ends, link_ends = overlaps(a_ends, b_ends)
        ends = np.cumsum(np.array([len(u.encode()) + 1 for u in units]))
        cuts = np.stack([np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, group_ends, link_ends)], axis=1)
        self.counts.frombytes(np.diff(cuts, axis=0, prepend=0).astype(np.int64).tobytes())
        self.starts.frombytes((len(self.links) + np.append(0, cuts[:-1, 3])).astype(np.int64).tobytes())
        pairs = (a[np.searchsorted(a_ends, link_ends)] << 32) | b[np.searchsorted(b_ends, link_ends)]
        self.links.frombytes(pairs.astype(np.int64).tobytes())
        upto = [np.searchsorted(x, group_ends) + 1 for x in (a_ends, b_ends)]
        text, places = spelled(a, b, *upto, self.names)
        places = places[cuts[:, 2] - 1].tolist()
        return [text[i : j - 1] for i, j in zip([0, *places], places, strict=False)]


remembered: dict[tuple, Units] = {}


def units_of(*key) -> Units:
    """The memory of a task, emptied where it has grown beyond its bound."""
    if key not in remembered:
        remembered[key] = Units(Tokenizers(*key))
    found = remembered[key]
    if len(found) > CACHE_UNITS or found.chars > CACHE_CHARS:
        found.forget()
    return found


def batch_of(**columns) -> pa.RecordBatch:
    """A batch with the given columns and nulls in the others."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ROW], schema=ROW
    )


class Chunk:
    """Texts gathered in a task until they are about ``CHUNK`` bytes."""

    def __init__(self, units: Units):
        self.units, self.size = units, 0
        self.rows: list[tuple] = []
        self.places: list[np.ndarray] = []
        self.copies: list[int] = []

    def add(self, texts: list[str], copies: list[int]) -> None:
        known = self.units
        cut = [list(map(known.__getitem__, known.tokenizers.units(t))) for t in texts]
        known.learn()
        for text, at, times in zip(texts, cut, copies, strict=True):
            data = text.encode()
            self.size += len(data)
            groups = list(map(known.groups.__getitem__, at))
            whole = None not in groups
            self.places.append(np.array(at if whole else [], np.int64))
            self.copies.append(times)
            key = hashlib.sha256(data).digest()
            self.rows.append((key, hashlib.sha256(";".join(groups).encode()).hexdigest() if whole else ""))

    def batches(self, number: int):
        """Rows of the texts, one row of the chunk's links, and a row for each of its pairs."""
        flat = np.concatenate(self.places)
        sizes = np.array([len(p) for p in self.places])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        used, local, often = np.unique(flat, return_inverse=True, return_counts=True)
        # Frequent units get small numbers, which take fewer bytes.
        order = np.argsort(-often, kind="stable")
        used, local = used[order], np.argsort(order)[local]
        rows = np.frombuffer(self.units.rows, np.int64)[used]
        counts = np.frombuffer(self.units.counts, np.int64).reshape(-1, len(COUNTS))[rows]
        sums = np.concatenate([np.zeros((1, len(COUNTS)), np.int64), np.cumsum(counts[local], axis=0)])
        totals = np.diff(sums[ends], axis=0)
        keys, digests = zip(*self.rows, strict=True)
        packed, lengths = pack(local)
        upto = np.concatenate([[0], np.cumsum(lengths)])[ends]
        yield batch_of(
            chunk=np.full(len(keys), number),
            key=keys,
            groups_sha256=digests,
            units=[packed[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)],
            **{name: totals[:, i] for i, name in enumerate(COUNTS)},
        )
        if not len(used):
            return
        start, size = np.frombuffer(self.units.starts, np.int64)[rows], counts[:, -1]
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        pairs, place = np.unique(np.frombuffer(self.units.links, np.int64)[at], return_inverse=True)
        yield batch_of(chunk=[number], link_ends=[np.cumsum(size)], links=[place])
        times = np.zeros(len(used), np.int64)
        np.add.at(times, local, np.repeat(np.array(self.copies, np.int64), sizes))
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, place, np.repeat(times, size))
        yield batch_of(chunk=np.full(len(pairs), number), pair=pairs, at=np.arange(len(pairs)), n=n)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes, seven bits in each, the last one of a number below 128; and their lengths."""
    values = values.astype(np.uint64)
    lengths = 1 + sum((values >= np.uint64(1 << 7 * k)).astype(np.int64) for k in range(1, 5))
    at = np.cumsum(lengths) - lengths
    out = np.zeros(int(lengths.sum()), np.uint8)
    for k in range(5):
        long = np.flatnonzero(lengths > k)
        digit = (values[long] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[long] + k] = digit + np.where(lengths[long] > k + 1, 128, 0).astype(np.uint64)
    return out, lengths


def unpack(data: np.ndarray) -> np.ndarray:
    """The numbers that :func:`pack` made bytes of."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)[: len(last)]
    shift = 7 * (np.arange(len(data)) - np.repeat(first, last - first + 1))
    return np.add.reduceat((data.astype(np.int64) & 127) << shift, first) if len(last) else np.zeros(0, np.int64)


def chunks(texts: DataFrame, a_path: str, b_path: str, size: int = CHUNK) -> DataFrame:
    """The rows of all chunks of distinct texts (text, copies)."""

    def made(batches):
        number = TaskContext.get().partitionId() << 32
        chunk = Chunk(units_of(a_path, b_path))
        for batch in batches:
            for start, n in slices(batch.column("text"), SLICE):
                part = batch.slice(start, n)
                chunk.add(part.column("text").to_pylist(), part.column("copies").to_pylist())
                if chunk.size >= size:
                    yield from chunk.batches(number)
                    number, chunk = number + 1, Chunk(units_of(a_path, b_path))
        if chunk.rows:
            yield from chunk.batches(number)

    return texts.select("text", "copies").mapInArrow(made, ROW_SQL)


MEASURES = "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def measured(rows: DataFrame) -> DataFrame:
    """The measures of every distinct text, by the SHA-256 of the text."""
    pairs = rows.filter("pair IS NOT NULL").select("chunk", "pair", "at", "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # A window holds one B id's pairs, no more than A has entries.
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = counts.withColumn("best", F.col("total") == F.max("total").over(same_b))
    known = pairs.select("chunk", "pair", "at").join(counts, "pair").select("chunk", "at", "total", "best")
    # A fresh alias keeps the two uses of the same rows apart.
    texts = rows.filter("pair IS NULL").select(
        F.col("chunk").alias("chunk"), "key", *COUNTS, "groups_sha256", "units", "link_ends", "links"
    )
    names = [part.strip().split(" ")[0] for part in MEASURES.split(",")]

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        values = np.zeros((right.num_rows, 2), np.int64)
        at = right.column("at").to_numpy()
        values[at, 0] = right.column("best").to_numpy().astype(np.int64)
        values[at, 1] = right.column("total").to_numpy()
        table = left.filter(pc.is_valid(left.column("key"))).combine_chunks()
        info = left.filter(pc.is_null(left.column("key")))
        link_ends, links = (
            (info.column(c)[0].values.to_numpy() for c in ("link_ends", "links"))
            if info.num_rows
            else (np.zeros(0, np.int64),) * 2
        )

        def summed(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
            """Sums of the runs of rows that end at ``ends``."""
            upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(rows, axis=0)])
            return np.diff(upto[np.concatenate([[0], ends])], axis=0)

        by_unit = summed(values[links], link_ends)
        units = [unpack(np.frombuffer(u.as_buffer(), np.uint8)) for u in table.column("units")]
        sums = summed(by_unit[np.concatenate([*units, np.zeros(0, np.int64)])], np.cumsum(list(map(len, units)), dtype=np.int64))
        table = table.append_column("n_best", pa.array(sums[:, 0])).append_column("count_sum", pa.array(sums[:, 1]))
        return table.select(names)

    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(measure, MEASURES)


def align_documents(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id and the measures of its text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = rows.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    found = materialize(measured(materialize(chunks(texts, a_path, b_path, chunk))))
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key")
    joined = salted_join(rows.select("doc_id", key), found, "key", "doc_id")
    numbers = [*COUNTS, "n_best", "count_sum"]
    return joined.select(
        "doc_id",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
