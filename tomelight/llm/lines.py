"""Near-duplicate lines by an exact set-similarity join, in column expressions only.

A line is the set of its words. Words are ordered by how often they occur in the
whole corpus, the rarest first. Of two sets of Jaccard similarity t or more that differ in d words
each of these parts at most one pair of neighbours among the words they share: from 0.75 on, of the
first d + 2 shared words two follow one another in both sets, and the first such two end
within the first 2 (1 - t) n + 2 words of a set of n. Sets meet under every such run of two words (below 0.75 under
every one of the first n - ceil(t n) + 1 words: prefix filter). They differ in size by a factor of
1 / t at most (length filter), and their bitmaps, in which each word turns one bit, differ in no
more bits than the sets may differ in words; what passes is verified. A line goes when an equal set or a set
at least ``SIMILARITY`` alike stands on an earlier line, in the order of doc_id and line.

Equal sets are one candidate, under their first line. Of the bucket of a run only sets stay that another of its sets
fits by size. There every set is first compared with the earliest one only: in a group of copies
that decides nearly every member. The sets that this leaves undecided are compared with all earlier sets
of their buckets.

Words are 32-bit hashes; the frequency of a word is that of its hash slot, a count
over all lines kept in a table of fixed size. Any fixed order of words gives the same
result, only slower or faster. Lists of keys are broadcast up to a checked number
of rows and joined by shuffle beyond it.

A set so small that one word more or less makes it unlike (one to three words at 0.8) can
only repeat an equal set: it is decided by its key and has no runs.

Defined results: null text stays null; a line of fewer than ``least`` distinct words (1 by default:
a line without words) is kept and compared with none; documents with a null doc_id are left as they are and
make no other line go; rows with the same doc_id and text are one document; a
document that loses all its lines has the empty text. Line ends are line feeds. Other columns
keep their values whatever their names, but for ``n_lines`` and ``n_dropped``, which are set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, once
from ..sources.store import materialize

SIMILARITY = 0.8
LEAST = 1
SLOTS = 2**20
WORD = r"[\p{L}\p{M}\p{N}]+"
#: From this similarity on, sets that are alike and not equal have two words in common that follow one another.
PAIRS_FROM = 0.75
#: Keys are broadcast up to this number of rows (of 40 bytes at most).
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast where its size allows. It is a written table: its rows are counted where they lie, none
    is brought to the driver for it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def word_set(line: Column) -> Column:
    """Distinct words of a line as sorted hashes."""
    words = F.transform(F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0)), lambda w: F.hash(w))
    return F.sort_array(F.array_distinct(words))


def line_sets(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, version (a hash of the text), line, words, key: a row per line of enough words."""
    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.posexplode(F.split("text", "\n", -1)).alias("line", "given"),
    )
    rows = once(rows, words=word_set(F.col("given"))).drop("given")
    return rows.filter(F.size("words") >= least).withColumn("key", F.xxhash64("words", F.size("words")))


def slot(word: Column) -> Column:
    return F.pmod(word, F.lit(SLOTS))


def slot_counts(sets: DataFrame) -> Column:
    """Occurrences of every hash slot over all lines, as one array of fixed length."""
    spark = sets.sparkSession
    seen = sets.select(F.explode("words").alias("word")).select(
        slot(F.col("word")).alias("slot"), F.lit(1).cast("long").alias("n")
    )
    none = spark.range(0, SLOTS, 1, 1).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("n"))
    counts = materialize(seen.union(none).groupBy("slot").agg(F.sum("n").alias("n")))
    # One number per slot, the slot in its upper half: sorting puts the counts in place.
    placed = F.shiftleft(F.col("slot").cast("long"), 32) + F.least("n", F.lit(2**30))
    return counts.agg(F.sort_array(F.collect_list(placed)).alias("counts")).scalar()


def by_rarity(words: Column, counts: Column) -> Column:
    """Words as numbers whose order is that of their frequency, then their hash."""
    return F.sort_array(
        F.transform(
            words,
            lambda w: F.shiftleft(F.get(counts, slot(w)), 32).bitwiseOR(
                w.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
            ),
        )
    )


def least_shared(n: Column, m: Column, t: float) -> Column:
    """The overlap two sets of these sizes need."""
    return F.ceil((n + m) * F.lit(t / (1 + t)) - F.lit(1e-9))


def can_differ(n: Column, t: float) -> Column:
    """Whether a set of this size is like any other than its equal: at best one word more or less."""
    return n >= (n + 1) * F.lit(t) - 1e-8


def can_match(x: Column, y: Column, t: float) -> Column:
    """Length and bitmap filter for two structs (n, low, high) of one bucket."""
    need = least_shared(x["n"], y["n"], t)
    sizes = F.least(x["n"], y["n"]) >= F.greatest(x["n"], y["n"]) * t - 1e-9
    differ = F.bit_count(x["low"].bitwiseXOR(y["low"])) + F.bit_count(x["high"].bitwiseXOR(y["high"]))
    return sizes & (differ <= x["n"] + y["n"] - 2 * need)


def bitmap(words: Column, which: int) -> Column:
    """64 bits: the words whose seventh bit is ``which`` each turn the bit that their lowest six name, so that of
    two bitmaps words in both sets leave no difference."""
    one = F.lit(1).cast("long")
    return F.aggregate(
        words,
        F.lit(0).cast("long"),
        lambda acc, w: F.when(
            w.bitwiseAND(F.lit(64)) == 64 * which, acc.bitwiseXOR(F.call_function("shiftleft", one, w.bitwiseAND(F.lit(63))))
        ).otherwise(acc),
    )


def runs(firsts: DataFrame, counts: Column, t: float) -> DataFrame:
    """Rows (run, key, n): the hashes of every set's first runs of words, and its size."""
    # The counts are never part of a row.
    ordered = firsts.filter(can_differ(F.size("words"), t)).withColumn("_counts", counts)
    ordered = ordered.select("key", by_rarity(F.col("words"), F.col("_counts")).alias("ordered"))
    n = F.size("ordered")
    if t < PAIRS_FROM:
        number = n - F.ceil(n * F.lit(t) - F.lit(1e-9)).cast("int") + 1
        run = [F.col("word")]
    else:
        number = F.least(n - 1, F.floor(n * F.lit(2 * (1 - t)) + F.lit(1e-9)).cast("int") + 1)
        run = [F.col("word"), F.get("ordered", F.col("at") + 1)]
    rows = ordered.select("key", "ordered", n.alias("n"), F.posexplode(F.slice("ordered", F.lit(1), number)).alias("at", "word"))
    return rows.select(F.xxhash64(*run).alias("run"), "key", "n")


def verify(pairs: DataFrame, firsts: DataFrame, t: float) -> DataFrame:
    """The pairs (a, b) of keys whose sets are similar; only their sets are moved."""
    keys = materialize(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    sets = materialize(firsts.join(small(keys), "key", "left_semi").select("key", "words"))
    left = sets.select(F.col("key").alias("a"), F.col("words").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("words").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(let(shared, lambda s: s >= least_shared(F.size("x"), F.size("y"), t)))
        .select("a", "b")
        .distinct()
    )


def earlier_pairs(rows: DataFrame, later: DataFrame, t: float) -> DataFrame:
    """Pairs (a, b): b of ``later`` with every earlier row of its bucket that passes the filters."""
    x = rows.select("run", F.col("key").alias("a"), F.col("rank").alias("ra"), F.col("me").alias("x"))
    y = later.select("run", F.col("key").alias("b"), F.col("rank").alias("rb"), F.col("me").alias("y"))
    joined = x.join(y, "run").filter((F.col("ra") < F.col("rb")) & (F.col("a") != F.col("b")))
    return joined.filter(can_match(F.col("x"), F.col("y"), t)).select("a", "b")


def matches(firsts: DataFrame, counts: Column, t: float) -> DataFrame:
    """Pairs (a, b): set b is like the set a, whose first line is earlier. Every b that has
    an earlier match is found, with at least one of its matches."""
    # A set stays in a bucket where the next smaller or the next larger one there is of a size to be like it.
    sizes, n = Window.partitionBy("run").orderBy("n"), F.col("n")
    smaller, larger = F.lag("n").over(sizes), F.lead("n").over(sizes)
    shared = runs(firsts, counts, t).select("run", "key", "n", smaller.alias("smaller"), larger.alias("larger"))
    fits = (F.col("smaller") >= n * t - 1e-9) | (n >= F.col("larger") * t - 1e-9)
    shared = shared.filter(fits).select("run", "key")
    shared = materialize(shared)
    keys = materialize(shared.select("key").distinct())
    sets = firsts.join(small(keys), "key", "left_semi").select("key", "doc_id", "line", "words")
    sets = materialize(sets.dropDuplicates(["key"]))
    me = F.struct(
        F.size("words").alias("n"), bitmap(F.col("words"), 0).alias("low"), bitmap(F.col("words"), 1).alias("high")
    )
    order = Window.partitionBy("run").orderBy("doc_id", "line", "key")
    rows = (
        shared.join(sets.select("key", "doc_id", "line", me.alias("me")), "key")
        .withColumn("rank", F.row_number().over(order))
        .withColumn("first", F.first(F.struct("key", "me")).over(order))
    )
    rows = materialize(rows.filter("rank > 1").select("run", "key", "me", "rank", "first"))

    near = (F.col("first.key") != F.col("key")) & can_match(F.col("first.me"), F.col("me"), t)
    star = rows.filter(near).select(F.col("first.key").alias("a"), F.col("key").alias("b")).distinct()
    found = materialize(verify(materialize(star), sets, t))
    decided = materialize(found.select(F.col("b").alias("key")).distinct())
    later = rows.filter("rank > 2").join(small(decided), "key", "left_anti")
    rest = materialize(earlier_pairs(rows, later, t).distinct())
    return found.union(verify(rest, sets, t))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """doc_id, version, line of every line that repeats an earlier one."""
    sets = materialize(line_sets(docs, least))
    here = F.struct("doc_id", "version", "line")
    copies = materialize(
        sets.groupBy("key").agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("first < last").drop("last")
    )
    marked = sets.join(small(copies), "key", "left")
    firsts = marked.filter(F.col("first").isNull() | (F.col("first") == here)).drop("first")
    later = marked.filter(F.col("first") != here).select("doc_id", "version", "line")
    found = matches(firsts, slot_counts(sets), similarity)
    alike = found.select(F.col("b").alias("key")).distinct()
    alone = firsts.join(small(materialize(alike)), "key", "left_semi").select("doc_id", "version", "line")
    return later.union(alone)


def drop_repeated(docs: DataFrame, similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """All documents with their columns, without the lines that repeat earlier ones.

    Adds ``n_lines`` and ``n_dropped``.
    """
    gone = repeated_lines(docs.select("doc_id", "text"), similarity, least)
    gone = materialize(gone.groupBy("doc_id", "version").agg(F.collect_set("line").alias("gone")))
    # A few rows may still hold many lines, so these are counted too.
    lists = gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    gone = small(gone) if lists <= BROADCAST_ROWS else gone
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("version")
    )
    joined = rows.join(gone, ["doc_id", "version"], "left")
    text = F.col("row.text")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = let(lines, lambda all_: F.array_join(F.transform(kept, lambda i: F.get(all_, i)), "\n"))
    made = F.struct(
        F.when(F.col("gone").isNull(), text).otherwise(left).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    others = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select("row", made.alias("made")).select(*others, "made.*")
