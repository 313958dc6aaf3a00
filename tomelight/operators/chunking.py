"""Structure-aware chunks of long documents, built inside each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.constants import TABLE_LITERAL, WARNING_PATTERN
from .positions import running_start

S = f"[{tx.SPACE}]"
# What may follow a line break at the start of a section. Matched
# without regard to case, so any run of letters and white space before a colon
# counts as a heading.
SECTION_START = (
    rf"\p{{Nd}}+\.{S}+|[A-Z][A-Z{tx.SPACE}]+:|CAUTION|WARNING|NOTE"
    rf"|Step{S}+\p{{Nd}}+:|Section{S}+\p{{Nd}}+"
)
PROCEDURE_START = rf"\p{{Nd}}+\.|Step{S}+\p{{Nd}}+"
MIN_DOCUMENT_CHARS = 20
MIN_CUT = 20
TRIM_RATIO = 0.7


def check_sizes(max_chunk_size: int, overlap: int, min_chunk_size: int) -> None:
    if max_chunk_size <= 0 or min_chunk_size < 0 or overlap < 0:
        raise ValueError("chunk sizes must be positive")
    if overlap >= max_chunk_size:
        raise ValueError("overlap must be smaller than max_chunk_size")


def tidy(text: Column) -> Column:
    """At most two line breaks in a row, single spaces, stripped."""
    return tx.strip(F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), " {2,}", " "))


def sections(text: Column, section_start: str = SECTION_START) -> Column:
    """Split tidied text in front of each line break that opens a section."""
    return F.split(text, rf"(?iu)(?=\n{S}*(?:{section_start}))")


def word_windows(words: Column, size: int, step: int) -> Column:
    """Overlapping windows of words, each joined by spaces."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, size), " "))


def covering_windows(words: Column, size: int, step: int, least: int) -> Column:
    """Windows that hold every word: a last window of under ``least`` words joins the one before."""
    n = F.size(words)
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda s: (s == 0) | (n - s >= least)
    )

    def cut(kept: Column) -> Column:
        length = lambda i: F.when(i + 1 < F.size(kept), F.lit(size)).otherwise(n)
        return F.transform(kept, lambda s, i: F.array_join(F.slice(words, s + 1, F.greatest(length(i), F.lit(0))), " "))

    return tx.let(starts, cut)


def trim_window(window: Column, max_chunk_size: int, trim_ratio: float = TRIM_RATIO) -> Column:
    """Cut after the last period or colon when it lies far enough into the window.

    The limit is a share of the window's *word* size compared with a *character*
    position, as published; words behind the cut can be lost.
    """

    def cut(kept: Column) -> Column:
        far = (kept - 1 > F.lit(max_chunk_size * trim_ratio)) & (kept - 1 > MIN_CUT)
        return F.when(far, F.left(window, kept)).otherwise(window)

    return tx.let(F.greatest(tx.before_last(window, "."), tx.before_last(window, ":")), cut)


def chunk_array(
    text: Column,
    max_chunk_size: int = 400,
    overlap: int = 50,
    min_chunk_size: int = 100,
    section_start: str = SECTION_START,
    trim_ratio: float = TRIM_RATIO,
    lossless: bool = False,
) -> Column:
    """All chunks of a text in order, as an array.

    Short sections are kept whole. Long ones become overlapping windows; a
    window with fewer than ``min_chunk_size`` words after trimming is dropped.
    With ``lossless`` nothing is trimmed and such a window joins the one before it.
    """
    check_sizes(max_chunk_size, overlap, min_chunk_size)

    def pieces(section: Column) -> Column:
        words = section["words"]
        whole = F.filter(F.array(tx.strip(section["body"])), lambda c: c != "")
        if lossless:
            return F.when(F.size(words) < min_chunk_size, whole).otherwise(
                covering_windows(words, max_chunk_size, max_chunk_size - overlap, min_chunk_size)
            )
        trimmed = F.transform(
            word_windows(words, max_chunk_size, max_chunk_size - overlap),
            lambda w: trim_window(w, max_chunk_size, trim_ratio),
        )
        # Windows hold single spaces only and a cut ends on a mark.
        long_enough = F.filter(
            trimmed,
            lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1
            >= min_chunk_size,
        )
        return F.when(F.size(words) < min_chunk_size, whole).otherwise(
            long_enough
        )

    parts = F.transform(
        sections(tidy(text), section_start),
        lambda s: F.struct(s.alias("body"), tx.space_words(s).alias("words")),
    )
    return F.flatten(F.transform(parts, pieces))


def is_warning(chunk: Column, pattern: str = WARNING_PATTERN) -> Column:
    return chunk.rlike(f"(?iu){pattern}")


def is_procedure(chunk: Column, pattern: str = PROCEDURE_START) -> Column:
    """True when the first line opens with a numbered step."""
    first_line = tx.strip(F.substring_index(chunk, "\n", 1))
    return first_line.rlike(f"(?iu)^(?:{pattern})")


def has_table(chunk: Column) -> Column:
    """Four or more pipes, or the literal marker text (not a pattern, as published)."""
    pipes = F.length(chunk) - F.length(F.replace(chunk, F.lit("|"), F.lit("")))
    return (pipes >= 4) | F.contains(chunk, F.lit(TABLE_LITERAL))


def chunk(
    df: DataFrame,
    text: str = "clean_text",
    id: str = "doc_id",
    filename: str = "filename",
    max_chunk_size: int = 400,
    overlap: int = 50,
    min_chunk_size: int = 100,
    section_start: str = SECTION_START,
    warning: str = WARNING_PATTERN,
    procedure: str = PROCEDURE_START,
    min_document_chars: int = MIN_DOCUMENT_CHARS,
    lossless: bool = False,
) -> DataFrame:
    """Chunk table keyed by (id, chunk_index); one map-only pass.

    With ``lossless`` and ``min_document_chars=0`` every word of every document is in a chunk.
    """
    array = chunk_array(
        F.col(text), max_chunk_size, overlap, min_chunk_size, section_start, lossless=lossless
    )
    body = F.col("chunk_text")
    return (
        df.filter(F.length(text) >= min_document_chars)
        .select(id, filename, F.posexplode(array).alias("chunk_index", "chunk_text"))
        .select(
            id,
            filename,
            "chunk_text",
            "chunk_index",
            is_warning(body, warning).alias("is_warning"),
            is_procedure(body, procedure).alias("is_procedure"),
            has_table(body).alias("has_table"),
            F.size(tx.space_words(body)).alias("num_words"),
        )
    )


def chunk_in_order(df: DataFrame, text: str = "clean_text", id: str = "doc_id", **options) -> DataFrame:
    """The chunks of :func:`chunk` with their place, for :func:`number_in_order`.

    Documents are dealt by ranges of ``id`` before they are cut, so chunks never move:
    ``_part`` is the task that makes a chunk and ``_row`` its place there.
    """
    ordered = df.repartitionByRange(id).sortWithinPartitions(id)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return chunk(ordered, text, id, **options).select("*", F.spark_partition_id().alias("_part"), row.alias("_row"))


def number_in_order(written: DataFrame) -> DataFrame:
    """Add the global sequential ``chunk_id`` in document order to a written :func:`chunk_in_order`.

    The parts' counts, one row per task that wrote, are added up and sent back;
    no chunk text is shuffled.
    """
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    numbered = written.join(F.broadcast(starts), "_part")
    return numbered.withColumn("chunk_id", F.col("_start") + F.col("_row")).drop("_part", "_row", "_start")


def number_chunks(chunks: DataFrame, id: str = "doc_id") -> DataFrame:
    """Add the global sequential ``chunk_id`` in document order.

    Documents get their starting number from a running total over the small
    per-document counts, so no task sorts all chunks.
    """
    counts = chunks.groupBy(id).agg(F.count(F.lit(1)).alias("_count"))
    starts = running_start(counts, id, "_count", "_start").select(id, "_start")
    return (
        chunks.join(starts, id)
        .withColumn("chunk_id", F.col("_start") + F.col("chunk_index"))
        .drop("_start")
    )


def reassemble(chunks: DataFrame, id: str = "doc_id", out: str = "text") -> DataFrame:
    """Join the chunks of each document in order; overlapping text appears twice."""
    ordered = F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_text")))
    return chunks.groupBy(id).agg(
        F.array_join(F.transform(ordered, lambda c: c["chunk_text"]), "\n\n").alias(out)
    )
