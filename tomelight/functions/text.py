"""Text expressions. Every function maps columns to a column and stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import BOILERPLATE, STOP_WORDS

# White space as Unicode defines it; Java's \s alone misses NBSP, NEL and
# the file/group/record/unit separators.
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WORD = r"\p{L}\p{N}_"
# ASCII letters and the four signs that equal one when case is ignored.
LATIN = "A-Za-zİıſ\u212a"
# A word boundary over Unicode letters and digits.
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def squeeze(text: Column) -> Column:
    """Collapse each white-space run to one space."""
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def clean(text: Column, boilerplate: Sequence[str] | None = None) -> Column:
    """Remove control characters, page numbers, model codes and boilerplate.

    Model codes are matched whatever their case and may reach into the following
    word; that is the published behaviour and is kept.
    """
    phrases = BOILERPLATE if boilerplate is None else list(boilerplate)
    # Look-behinds follow the literal they guard, so that most positions fail on
    # one character; possessive runs cannot be entered twice.
    steps = [
        r"(?iu)(?:Página|Page) *\p{Nd}+",
        rf"(?<![{WORD}])[{LATIN}]{{2,}}+\p{{Nd}}+[-_, ]*\p{{Nd}}*[{LATIN}]*\p{{Nd}}*{EDGE}",
        rf"(?iu)Part(?<![{WORD}]Part) +\p{{Nd}}+(?![{WORD}])",
        rf"(?<![{WORD}])\p{{Nd}}+-\p{{Nd}}+ +\p{{Nd}}+(?![{WORD}])",
    ]
    if phrases:
        opening = f"(?:{'|'.join(phrases)})"
        steps.append(rf"(?iu){opening}(?<![{WORD}]{opening}).*?valve \p{{Nd}}+\.?{EDGE}")

    def remove(out: Column) -> Column:
        for pattern in steps:
            out = F.regexp_replace(out, pattern, "")
        return out

    visible = F.regexp_replace(squeeze(text), r"[\x00-\x1f\x7f-\x9f]", "")
    # Every step needs a digit; a text without one is left as it is.
    kept = let(visible, lambda t: F.when(t.rlike(r"\p{Nd}"), remove(t)).otherwise(t))
    return F.trim(F.regexp_replace(kept, " {2,}", " "))


# Token rules in order: closing and opening marks stand alone, a colon or comma
# stands alone unless a digit follows, a period ends a sentence when only
# closing marks separate it from a space, and contractions are split.
TOKEN_RULES = [
    (r"(\.\.\.|--|[;@#$%&?!\]\[(){}<>\"“”«»…])", r" $1 "),
    (r"([:,])([^0-9]|$)", r" $1 $2"),
    (r"([^.])\.([\]\)}>\"'»” ]*)( |$)", r"$1 .$2$3"),
]
CONTRACTION = (r"([^' ])('(?:[sSmMdD]|ll|LL|re|RE|ve|VE)?|n't|N'T)( |$)", r"$1 $2$3")


def tokens(text: Column) -> Column:
    """Split cleaned text into word and punctuation tokens."""
    spaced = text
    for pattern, replacement in TOKEN_RULES:
        spaced = F.regexp_replace(spaced, pattern, replacement)
    split_off = let(
        spaced,
        lambda t: F.when(F.contains(t, F.lit("'")), F.regexp_replace(t, *CONTRACTION)).otherwise(t),
    )
    return F.filter(F.split(split_off, " "), lambda t: t != "")


def fold_case(words: Column) -> Column:
    return F.transform(words, F.lower)


def keep_alnum(words: Column) -> Column:
    """Keep only tokens made entirely of letters and digits."""
    return F.filter(words, lambda t: t.rlike(r"^[\p{L}\p{N}]+$"))


def drop_stop_words(words: Column, stop_words: Sequence[str] | None = None) -> Column:
    stops = STOP_WORDS if stop_words is None else list(stop_words)
    return F.filter(words, lambda t: ~t.isin(stops)) if stops else words


def s_stem(word: Column) -> Column:
    """Plural stripping after Harman (1991): ies -> y, es -> e, s -> nothing.

    The first ending that fits decides; its exceptions leave the word alone.
    """

    def ends(*suffixes: str) -> Column:
        test = word.endswith(suffixes[0])
        for s in suffixes[1:]:
            test = test | word.endswith(s)
        return test

    def chop(n: int) -> Column:
        return F.left(word, F.length(word) - F.lit(n))

    return (
        F.when(F.length(word) < 3, word)
        .when(ends("ies") & ~ends("eies", "aies"), F.concat(chop(3), F.lit("y")))
        .when(ends("es") & ~ends("aes", "ees", "oes", "ies"), chop(1))
        .when(ends("s") & ~ends("us", "ss", "es"), chop(1))
        .otherwise(word)
    )


def stem(words: Column, stemmer: Callable[[Column], Column] = s_stem) -> Column:
    """Stem each token; ``stemmer`` maps a string column to a string column."""
    return F.transform(words, stemmer)


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.filter(F.split(text, rf"(?<=[.!?])[{SPACE}]+"), lambda s: s != "")


def space_words(text: Column) -> Column:
    """Words separated by white space, as a blank-safe split."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda t: t != "")


def word_terms(text: Column, min_chars: int = 1) -> Column:
    """Lower-cased runs of letters, digits and underscores."""
    return F.filter(
        F.split(F.lower(text), f"[^{WORD}]+"), lambda t: F.length(t) >= min_chars
    )


def ngrams(words: Column, n: int) -> Column:
    """Space-joined n-grams in order; empty when there are fewer than n words."""
    if n == 1:
        return words

    def joined(w: Column, i: Column) -> Column:
        parts = [F.get(w, i)]
        for k in range(1, n):
            parts += [F.lit(" "), F.get(w, i + k)]
        return F.concat(*parts)

    def grams(w: Column) -> Column:
        last = F.size(w) - n
        return F.when(last < 0, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: joined(w, i))
        )

    return let(words, grams)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where body repeats it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(words: Column, name: str = "term") -> Column:
    """Distinct values of an array with their counts, as structs (name, tf).

    The array is sorted and its runs are measured, all within the row.
    """

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda p, j: F.struct(
                F.get(ordered, p).alias(name),
                (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - p).cast("long").alias("tf"),
            ),
        )

    def starts(ordered: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(ordered) - 1, F.lit(0))),
            lambda i: (F.size(ordered) > 0)
            & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )

    present = F.filter(words, lambda t: t.isNotNull())
    return let(F.sort_array(present), lambda o: let(starts(o), lambda s: runs(o, s)))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Filters and projections on a plain column are merged into its expression and
    evaluate it again; a generated column keeps them apart.
    """
    values = [column.alias(name) for name, column in columns.items()]
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*values))))


def before_last(text: Column, mark: str) -> Column:
    """Length of the prefix that ends with the last ``mark``; 0 when absent."""
    return F.length(text) - F.length(F.substring_index(text, mark, -1))
