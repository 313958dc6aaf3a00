"""Corpus build and corpus statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .joins import salted_join


def normalize(
    df: DataFrame,
    text: str = "raw_text",
    boilerplate: Sequence[str] | None = None,
    out: str = "clean_text",
) -> DataFrame:
    """Add the cleaned text."""
    return tx.once(df, **{out: tx.clean(F.col(text), boilerplate)})


def tokenize(df: DataFrame, text: str = "clean_text", out: str = "tokens_original") -> DataFrame:
    return df.withColumn(out, tx.tokens(F.col(text)))


def analyze(
    df: DataFrame,
    text: str = "raw_text",
    boilerplate: Sequence[str] | None = None,
    stop_words: Sequence[str] | None = None,
    stemmer: Callable[[Column], Column] = tx.s_stem,
) -> DataFrame:
    """Clean, tokenise, stem and split each document; one map-only pass.

    ``num_tokens`` counts tokens after stop-word removal. Lemmas default to the
    stems; :func:`lemmatize` replaces them from a lexicon.
    """
    out = normalize(df, text, boilerplate)
    words = tx.keep_alnum(tx.tokens(F.lower("clean_text")))
    return (
        tx.once(out, tokens=tx.drop_stop_words(words, stop_words))
        .withColumn("tokens_stemmed", tx.stem(F.col("tokens"), stemmer))
        .withColumn("lemmas", tx.drop_stop_words(F.col("tokens_stemmed"), stop_words))
        .withColumn("sentences", tx.sentences(F.col("clean_text")))
        .withColumn("num_tokens", F.size("tokens"))
        .withColumn("num_sentences", F.size("sentences"))
    )


PROCESSED = [
    "filename",
    "raw_text",
    "clean_text",
    "tokens",
    "tokens_stemmed",
    "lemmas",
    "sentences",
    "num_tokens",
    "num_sentences",
]


def build_corpus(df: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """Processed-document table: texts with at least one token, declared columns only."""
    kept = df.filter(F.col("raw_text").isNotNull() & (F.col("raw_text") != ""))
    return analyze(kept, **options).filter("num_tokens > 0").select(id, *PROCESSED)


def lemmatize(
    df: DataFrame,
    lexicon: DataFrame,
    id: str = "doc_id",
    tokens: str = "tokens",
    out: str = "lemmas",
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Replace each token by its lexicon lemma, keep unknown tokens, drop stop words.

    ``lexicon`` has one row per form: form, lemma. Returns id and the lemmas in
    token order; a document without tokens gets an empty list.
    """
    forms = df.select(id, F.posexplode_outer(tokens).alias("pos", "form"))
    known = salted_join(forms, lexicon.select("form", "lemma"), "form", "pos")
    lemma = F.coalesce("lemma", "form")
    pairs = F.sort_array(
        F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", lemma.alias("lemma"))))
    )
    ordered = F.transform(pairs, lambda p: p["lemma"])
    return known.groupBy(id).agg(tx.drop_stop_words(ordered, stop_words).alias(out))


def corpus_stats(
    df: DataFrame, tokens: str = "tokens", approximate: bool = False
) -> DataFrame:
    """One row: documents, tokens, sentences, distinct tokens, mean length."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    distinct = df.select(F.explode(tokens).alias("t")).agg(count("t").alias("n"))
    return df.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.sum("num_tokens").alias("total_tokens"),
        F.sum("num_sentences").alias("total_sentences"),
        F.avg("num_tokens").alias("avg_doc_length"),
    ).select(
        "total_documents",
        "total_tokens",
        "total_sentences",
        distinct.scalar().alias("unique_tokens"),
        "avg_doc_length",
    )


def length_histogram(df: DataFrame, column: str = "num_tokens", bins: int = 25) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last bin closed on the right.

    Empty bins are listed with a count of 0; ``mean`` marks the column mean. When
    all values are equal the range is widened by one half on each side.
    """
    value = F.col(column).cast("double")
    range_ = df.agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mean")
    ).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "mean",
    )
    bounds = range_.select(F.struct("lo", "hi", "mean")).scalar()
    counts = (
        df.select(value.alias("v"), bounds.alias("b"))
        .groupBy(
            F.least(
                F.width_bucket("v", F.col("b.lo"), F.col("b.hi"), F.lit(bins)),
                F.lit(bins).cast("long"),
            ).alias("bin")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = range_.filter(F.col("lo").isNotNull()).select(
        "lo", "hi", "mean", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin")
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("low"),
        (F.col("lo") + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        "mean",
    )


def top_terms(df: DataFrame, terms: str = "lemmas", n: int = 15) -> DataFrame:
    """The most frequent terms over the corpus; ties in term order."""
    return (
        df.select(F.explode(terms).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("freq"))
        .orderBy(F.desc("freq"), "term")
        .limit(n)
    )


def distinct_terms(df: DataFrame, terms: str = "lemmas") -> DataFrame:
    return df.select(F.explode(terms).alias("term")).agg(
        F.count_distinct("term").alias("n_terms")
    )


def corpus_string(df: DataFrame, terms: str = "lemmas", out: str = "corpus") -> DataFrame:
    """Space-joined terms: null elements dropped, a missing list gives ``''``.

    A column that is not an array is taken as its string.
    """
    kind = df.schema[terms].dataType.typeName()
    if kind == "array":
        present = F.filter(F.col(terms), lambda t: t.isNotNull())
        text = F.array_join(F.transform(present, lambda t: t.cast("string")), " ")
    else:
        text = F.col(terms).cast("string")
    return df.withColumn(out, F.coalesce(text, F.lit("")))
