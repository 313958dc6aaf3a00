"""Document fingerprints from closed syncmers, in column expressions only.

A text is a sequence of units: runs of letters and digits in lower case, and
single characters of scripts that put no spaces between words. Of all windows
of ``K`` units (k-mers) those are kept, as *anchors*, whose smallest inner window
of ``S`` units (s-mers, ordered by hash) is the first or the last one. Whether a
k-mer is kept depends on its own units alone, so a passage has the same anchors
wherever it stands, and an edit changes only the anchors that it touches.

Defined results: a null text counts as empty; the empty text has no anchor; a
text whose k-mers hold no closed syncmer, or that has fewer than ``K`` units, has
one anchor, the hash of all its units (of the text itself when it has none).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, once

K, S = 5, 2
#: Scripts written without spaces: each character is a unit.
SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
UNIT = rf"[{SINGLE}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{SINGLE}]]+"
#: Rows that a block of neighbouring keys holds on average.
BLOCK_ROWS = 128


def units(text: Column) -> Column:
    """The units of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0))


def closed(s_mers: Column, i: Column, k: int, s: int) -> Column:
    """Whether the smallest s-mer of the k-mer at ``i`` is its first or its last."""
    ends = F.least(F.get(s_mers, i), F.get(s_mers, i + (k - s)))
    inner = [F.get(s_mers, i + j) for j in range(1, k - s)]
    return ends <= (F.least(*inner) if len(inner) > 1 else inner[0])


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Anchors of a text as structs (pos, hash), in ascending ``pos`` (unit number)."""
    if not 0 < s < k - 1:
        raise ValueError("s must be at least 1 and less than k - 1")

    def of_hashes(words: Column) -> Column:
        def of_s_mers(s_mers: Column) -> Column:
            # Whole s-mers side by side, then the units that are left, make up the k-mer.
            whole = [lambda i, j=j: F.get(s_mers, i + j) for j in range(0, k - s + 1, s)]
            rest = [lambda i, j=j: F.get(words, i + j) for j in range(k - k % s, k)]
            starts = F.when(
                F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)
            ).otherwise(F.array().cast("array<int>"))
            return F.transform(
                F.filter(starts, lambda i: closed(s_mers, i, k, s)),
                lambda i: F.struct(
                    i.alias("pos"), F.xxhash64(*(f(i) for f in whole + rest)).alias("hash")
                ),
            )

        pieces = F.transform(
            words, lambda x, i: F.xxhash64(x, *(F.get(words, i + j) for j in range(1, s)))
        )
        found = let(pieces, of_s_mers)
        whole_text = F.struct(
            F.lit(0).alias("pos"),
            F.when(F.size(words) > 0, F.xxhash64(words)).otherwise(F.xxhash64(given)).alias("hash"),
        )
        return let(
            found,
            lambda a: F.when((F.size(a) > 0) | (given == ""), a).otherwise(F.array(whole_text)),
        )

    given = F.coalesce(text, F.lit(""))
    return let(F.transform(units(given), lambda w: F.xxhash64(w)), of_hashes)


def hashes(found: Column) -> Column:
    return F.transform(found, lambda a: a["hash"])


def fingerprint(found: Column) -> Column:
    """All anchors in text order, eight hexadecimal digits each, as one string."""
    digits = F.transform(
        found, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    )
    return F.array_join(digits, "")


def likeness(left: Column, right: Column) -> Column:
    """Shared part of two sets of anchor hashes, 0 to 1; two empty sets are alike."""
    return let(
        F.size(F.array_union(left, right)),
        lambda n: F.when(n == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(left, right)) / n
        ),
    )


def previous(blocks: DataFrame) -> DataFrame:
    """Add ``_to``, the block before each block; null for the first.

    Blocks are ordered in spans of 2^12 numbers; only one row per span is ordered as a whole.
    """
    spans = blocks.withColumn("_span", F.shiftright("_block", 12))
    inside = Window.partitionBy("_span").orderBy("_block")
    tops = spans.groupBy("_span").agg(F.max("_block").alias("_top"))
    tops = tops.select("_span", F.lag("_top").over(Window.orderBy("_span")).alias("_top"))
    return (
        spans.withColumn("_to", F.lag("_block").over(inside))
        .join(tops, "_span")
        .select("_block", F.coalesce("_to", "_top").alias("_to"))
    )


def with_next(rows: DataFrame, key: str, columns: Sequence[str], prepare=None) -> DataFrame:
    """Add ``next``, the ``columns`` of the row with the next greater key; the last gets the first's.

    Rows move once, to blocks of neighbouring keys; only the first row of each
    block moves again, to the block before it. ``prepare`` is applied to the rows
    of a block before they are sorted. Null keys come first, equal keys in the
    order of ``columns``.
    """
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    width = 1 if low is None else max(1, (high - low + 1) * BLOCK_ROWS // n)
    last = -1 if low is None else (high - low) // width
    block = F.lit(-1).cast("long") if low is None else F.coalesce(
        F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(-1)
    )
    numbered = rows.withColumn("_block", block)
    dealt = numbered.repartition("_block")
    prepare = prepare or (lambda frame: frame)
    by = Window.partitionBy("_block").orderBy(F.col(key).asc_nulls_first(), *columns[1:2])
    opening = prepare(dealt.withColumn("_n", F.row_number().over(by)).filter("_n = 1"))
    firsts = opening.join(previous(numbered.select("_block").distinct()), "_block").select(
        F.coalesce("_to", F.lit(last)).alias("_to"), F.struct(*columns).alias("_first")
    )
    rows = prepare(dealt).withColumn("next", F.lead(F.struct(*columns)).over(by))
    joined = rows.join(firsts, (F.col("_block") == F.col("_to")) & F.col("next").isNull(), "left")
    return joined.withColumn("next", F.coalesce("next", "_first")).drop("_block", "_to", "_first")


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next document. Other columns of ``docs`` are ignored. One row
    out per row in; with a single row the next document is that row itself.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def prepare(dealt: DataFrame) -> DataFrame:
        return once(dealt, _own=anchors(F.col("text")))

    paired = with_next(rows, "doc_id", ["doc_id", "text", "_own"], prepare)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.col("next.text"), F.lit(1), half),
    )
    paired = once(paired, _edited=edited)
    paired = once(paired, _other=anchors(F.col("_edited")))
    own, other, following = (
        hashes(F.col(c)) for c in ("_own", "_other", "next._own")
    )
    return paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, following).alias("near_next"),
    )
