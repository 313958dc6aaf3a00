"""Token ids as Parquet list columns for selective reads.

One row per document in ascending id order: ``doc_id`` and ``n_tokens`` (delta
encoded) and ``ids``, the list of token ids with the end id (dictionary encoded:
a vocabulary fits one dictionary page, so an id takes as many bits as it needs).
Row groups and pages have set sizes and page indexes are written, so that a reader
who wants lengths reads no ids, and one who wants some documents reads their pages
only.

Texts are encoded by the tokenizer's own library, word by word: words are cut at
spaces and line feeds, which the pre-tokenizer never puts into a token, and a worker
remembers the ids of recent words. A tokenizer for which that does not hold is given
``by_word=False``.

Defined results: a null text is empty and has the end id alone; rows with a null
doc_id come first; an empty table gives files without rows. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.positions import running_start
from .folders import new_folder
from .workers import kept

END_ID = 1
#: Writer settings; sizes in bytes.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 * 1024 * 1024),
    "parquet.page.size": str(256 * 1024),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(1024 * 1024),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
#: Words whose ids a Python worker remembers, and bytes of text encoded at a time.
CACHE_WORDS = 200_000
BATCH_BYTES = 4_000_000
#: Letters that lower-casing and composition treat one by one, and signs behind them.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
PROBES = ["Hello", "it", "Straße", "ÉÀÿ", "extraordinarily", "Ünïcödé", "QX"]
#: How byte-level vocabularies write bytes: printable ones as themselves, others from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


class WordIds(dict):
    """Places of words in a pool of ids; unknown words are encoded when asked for.

    Where the tokenizer lower-cases and writes bytes as letters, which is tried out on a
    few words, a word of plain letters goes straight to its model, and signs behind it
    are looked up apart, as the pre-tokenizer cuts there. ``before`` is an older table;
    what is still in use moves over from it.
    """

    def __init__(self, tokenizer, before: WordIds | None = None):
        super().__init__()
        self.tokenizer, self.model, self.before = tokenizer, tokenizer.model, before
        if before:
            before.before = None
        self.pool, self.starts, self.counts = (array("i") for _ in range(3))
        self.signs: dict[str, list[int]] = {"": []}
        named = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.direct = before.direct if before else all(
            any(c.isalnum() for c in name) for name in named
        ) and all(self.plain(p) + self.run(r) == self.whole(p + r) for p in PROBES for r in ("", ",", "!?'"))

    def whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def run(self, signs: str) -> list[int]:
        found = self.signs.get(signs)
        if found is None:
            found = self.signs[signs] = self.whole(signs)
        return found

    def plain(self, word: str) -> list[int]:
        shown = word.lower()
        if not shown.isascii():
            shown = shown.encode().decode("latin-1").translate(BYTES)
        return [t.id for t in self.model.tokenize(shown)]

    def ids(self, word: str) -> list[int]:
        old = self.before.get(word) if self.before else None
        if old is not None:
            start = self.before.starts[old]
            return self.before.pool[start : start + self.before.counts[old]]
        parts = PLAIN.fullmatch(word) if self.direct else None
        if not parts:
            return self.whole(word)
        letters, signs = parts.groups()
        small = letters.lower()
        if small == word:
            return self.plain(small)
        # The same letters in other cases, and before other signs, are encoded once.
        place = self[small]
        start = self.starts[place]
        return [*self.pool[start : start + self.counts[place]], *self.run(signs)]

    def __missing__(self, word: str) -> int:
        found = self.ids(word) if word else []
        place = self[word] = len(self.starts)
        self.starts.append(len(self.pool))
        self.counts.append(len(found))
        self.pool.extend(found)
        return place


class WordEncoder:
    """Encodes arrays of texts; remembers the ids of some ``CACHE_WORDS`` words, twice."""

    def __init__(self, path: str, end_id: int, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.by_word = Tokenizer.from_file(path), end_id, by_word
        self.known = WordIds(self.tokenizer)

    def lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by the end id; and their counts."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            ids = [[*x.ids, self.end_id] for x in found]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((i for x in ids for i in x), np.int32, int(counts.sum())), counts
        if len(self.known) > CACHE_WORDS:
            self.known = WordIds(self.tokenizer, self.known)
        known = self.known
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = (split.offsets.to_numpy() - split.offsets[0].as_py())[1:]
        # Each distinct word of the texts is looked up once.
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(known.__getitem__, distinct), np.int32, len(distinct))[words.indices.to_numpy()]
        pool, starts, all_counts = (np.array(x, np.int32) for x in (known.pool, known.starts, known.counts))
        sizes = all_counts[places]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        bounds = upto[np.concatenate([[0], ends])]
        total, counts = int(upto[-1]), np.diff(bounds)
        ids = pool[np.repeat(starts[places] - upto[:-1], sizes) + np.arange(total)]
        out = np.insert(ids, bounds[1:], self.end_id)
        return out.astype(np.int32, copy=False), counts + 1


def encoder(*key) -> WordEncoder:
    """One encoder per Python worker, so that tasks share what it remembers."""
    return kept(("encoder", *key), lambda: WordEncoder(*key))


def slices(texts: pa.Array, limit: int):
    """Starts and lengths of runs of texts of about ``limit`` bytes each."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop - start
        start = stop


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, by_word: bool = True, **options
) -> None:
    """Encode all texts and write them in ascending doc_id order."""

    def encoded(batches):
        use = encoder(tokenizer, end_id, by_word)
        for batch in batches:
            for start, size in slices(batch.column("text"), BATCH_BYTES):
                ids, counts = use.lists(batch.column("text").slice(start, size))
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, size),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = ordered.mapInArrow(encoded, "doc_id long, n_tokens long, ids array<int>")
    made.write.options(**{**WRITER, **options}).parquet(path)


def read_tokens(
    spark: SparkSession, path: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """The stored rows; with bounds on doc_id, only the pages that hold them."""
    rows = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    if low is not None:
        rows = rows.filter(F.col("doc_id") >= low)
    return rows if high is None else rows.filter(F.col("doc_id") <= high)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens and ids_crc32 of the stored ids as little-endian 32-bit integers."""

    def summed(batches):
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        summed, "doc_id long, n_tokens long, ids_crc32 long"
    )


def stored_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write all documents below the shared folder; per document what the files hold.

    ``start`` is the number of ids before the document. Documents with the same id
    follow one another by length and checksum.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "tokens")
    write_tokens(docs, path, tokenizer, **options)
    key = F.coalesce("doc_id", F.lit(-(2**63))).alias("_key")  # null ids come first
    lengths = read_tokens(spark, path).groupBy(key).agg(F.sum("n_tokens").alias("_n"))
    starts = running_start(lengths, "_key", "_n").select("_key", "start")
    same = Window.partitionBy("_key").orderBy("n_tokens", "ids_crc32")
    before = F.sum("n_tokens").over(same.rowsBetween(Window.unboundedPreceding, -1))
    return (
        checksums(read_tokens(spark, path))
        .withColumn("_key", key)
        .join(starts, "_key")
        .withColumn("start", F.col("start") + F.coalesce(before, F.lit(0)))
        .drop("_key")
    )
