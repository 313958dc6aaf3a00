"""Word vectors: windows to train on, look-up, out-of-vocabulary reports, document means.

A word-vector table has the columns word and vector; :mod:`skipgram` trains one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from ..sources.store import materialize
from . import blocks, topk
from .joins import salted_join

OOV_SAMPLE = 50


def windows(
    df: DataFrame, terms: str = "lemmas", size: int = 10, min_terms: int = 3, id: str = "doc_id"
) -> DataFrame:
    """Tumbling windows over each term list: id, pos, sentence."""
    starts = F.when(
        F.size(terms) > 0, F.sequence(F.lit(0), F.size(terms) - 1, F.lit(size))
    ).otherwise(F.array().cast("array<int>"))
    cut = F.transform(starts, lambda s: F.slice(terms, s + 1, size))
    return df.select(id, F.posexplode(cut).alias("pos", "sentence")).filter(
        F.size("sentence") >= min_terms
    )


def subwords(word: Column, min_n: int = 3, max_n: int = 6) -> Column:
    """Distinct character n-grams of ``<word>``."""

    def grams(marked: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
        found = F.transform(starts, lambda i: F.substring(marked, i, F.lit(n)))
        return F.filter(found, lambda g: F.length(g) == n)

    def all_grams(marked: Column) -> Column:
        return F.array_distinct(F.concat(*[grams(marked, n) for n in range(min_n, max_n + 1)]))

    return tx.let(F.concat(F.lit("<"), word, F.lit(">")), all_grams)


def subword_vectors(
    words: DataFrame, min_n: int = 3, max_n: int = 6, among: DataFrame | None = None
) -> DataFrame:
    """Each n-gram's vector is the mean over the words that contain it: gram, vector, n_words.

    ``among`` (a gram column) names the n-grams that are wanted; all by default.
    """
    listed = words.select("word", F.explode(subwords(F.col("word"), min_n, max_n)).alias("gram"))
    if among is not None:
        listed = listed.join(among.select("gram").distinct(), "gram", "left_semi")
    dim = vx.dimension(words, "vector")
    sums = blocks.weighted_sums(listed.withColumn("weight", F.lit(1)), words, dim, "gram")
    mean = F.transform("sums", lambda x: x / F.col("n"))
    return sums.select("gram", mean.alias("vector"), F.col("n").cast("long").alias("n_words"))


def with_subwords(
    wanted: DataFrame, words: DataFrame, grams: DataFrame | None = None, min_n: int = 3, max_n: int = 6
) -> DataFrame:
    """Vectors for any word: its own when trained, else the mean of its known n-grams.

    ``wanted`` has a word column. A word without a known n-gram gets zeros. Without
    ``grams`` the vectors of the n-grams that unseen words need are made from ``words``.
    """
    dim = vx.dimension(words, "vector")
    asked = wanted.select("word").distinct().join(words, "word", "left")
    unseen = materialize(
        asked.filter(F.col("vector").isNull()).select(
            "word", F.explode(subwords(F.col("word"), min_n, max_n)).alias("gram")
        )
    )
    if grams is None:
        grams = materialize(subword_vectors(words, min_n, max_n, unseen))
    edges = unseen.withColumn("weight", F.lit(1))
    sums = blocks.weighted_sums(edges, grams, dim, "word", word="gram")
    built = sums.select("word", F.transform("sums", lambda x: x / F.col("n")).alias("built"))
    return asked.join(built, "word", "left").select(
        "word",
        F.coalesce(vx.as_double(F.col("vector")), "built", vx.zeros(dim)).alias("vector"),
        F.col("vector").isNotNull().alias("trained"),
    )


def oov_report(
    df: DataFrame,
    words: DataFrame,
    model: str,
    terms: str = "lemmas",
    subword: bool = False,
    sample: int = OOV_SAMPLE,
) -> DataFrame:
    """One row: distinct words, how many a model knows, and the first unknown ones.

    Sub-word models represent every word, so nothing is unknown to them.
    """
    distinct = df.select(F.explode(terms).alias("word")).distinct()
    if subword:
        marked = distinct.withColumn("known", F.lit(True))
    else:
        have = words.select("word").distinct().withColumn("known", F.lit(True))
        marked = distinct.join(have, "word", "left")
    unknown = marked.filter(F.col("known").isNull())
    first = (
        unknown.select("word")
        .orderBy("word")
        .limit(sample)
        .agg(F.sort_array(F.collect_list("word")))
        .scalar()
    )
    return marked.agg(
        F.count(F.lit(1)).alias("total_words"), F.count("known").alias("in_vocab")
    ).select(
        F.lit(model).alias("model"),
        "total_words",
        "in_vocab",
        (F.col("total_words") - F.col("in_vocab")).alias("oov_count"),
        F.try_divide(
            (F.col("total_words") - F.col("in_vocab")) * 100.0, F.col("total_words")
        ).alias("oov_percentage"),
        first.alias("oov_words"),
    )


def compare_oov(df: DataFrame, models: dict[str, DataFrame | None], **options) -> DataFrame:
    """One report row per named model; a model that is not fitted (None) has none."""
    fitted = {name: words for name, words in models.items() if words is not None}
    if not fitted:
        raise ValueError("no fitted model given")
    out = None
    for name, words in fitted.items():
        row = oov_report(df, words, name, **options)
        out = row if out is None else out.unionByName(row)
    return out


def pair_similarity(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Cosine of word1 and word2; null when a word is unknown."""
    one = words.select(F.col("word").alias("word1"), F.col("vector").alias("_a"))
    two = words.select(F.col("word").alias("word2"), F.col("vector").alias("_b"))
    left = salted_join(pairs, one, "word1", "word2")
    return (
        salted_join(left, two, "word2", "word1")
        .withColumn("similarity", vx.cosine(F.col("_a"), F.col("_b")))
        .drop("_a", "_b")
    )


def nearest_words(
    words: DataFrame, n: int = 10, queries: DataFrame | None = None, **blocks
) -> DataFrame:
    """The n most similar words of each query word, never itself.

    ``queries`` has a word column; unknown words return nothing. All words are
    looked up by default.
    """
    wanted = words if queries is None else words.join(queries.select("word"), "word", "left_semi")
    sides = [topk.side(df, "word", "vector", None, None) for df in (wanted, words)]
    return topk.nearest(*sides, n, skip_self=True, **blocks)


def doc_means(
    df: DataFrame,
    words: DataFrame,
    terms: str = "lemmas",
    id: str = "doc_id",
    oov: str = "skip",
    dim: int | None = None,
) -> DataFrame:
    """Mean word vector of each document, repeats counted: id, embedding.

    ``oov="skip"`` averages known words only, ``oov="zero"`` counts an unknown
    word as zeros. A document without known words gets zeros. Terms are counted
    in the row first, so a document sends each distinct word once, and only sums
    of vectors leave a task.
    """
    if oov not in ("skip", "zero"):
        raise ValueError("oov must be 'skip' or 'zero'")
    dim = vx.dimension(words, "vector") if dim is None else dim
    present = F.filter(F.coalesce(F.col(terms), F.array().cast("array<string>")), lambda t: t.isNotNull())
    rows = df.select(id, present.alias("_terms"))
    counted = rows.select(id, F.inline(tx.term_counts(F.col("_terms"), "word")))
    sums = blocks.weighted_sums(counted, words, dim, id, weight="tf")
    every = rows.groupBy(id).agg(F.sum(F.size("_terms")).alias("_all"))
    number = F.greatest(F.coalesce(F.col("_all") if oov == "zero" else F.col("n"), F.lit(1)), F.lit(1))
    mean = F.transform(F.coalesce("sums", vx.zeros(dim)), lambda x: x / number)
    return every.join(sums, id, "left").select(id, mean.alias("embedding"))


def select_words(
    words: DataFrame,
    frequencies: DataFrame | None = None,
    n: int = 50,
    chosen: Sequence[str] | None = None,
) -> DataFrame:
    """Vectors of the n most frequent words (term, freq), or of a given list."""
    if chosen is not None:
        return words.filter(F.col("word").isin(list(chosen)))
    ranked = frequencies.select(F.col("term").alias("word"), "freq")
    return words.join(ranked, "word").orderBy(F.desc("freq"), "word").limit(n)


def covariance(df: DataFrame, vector: str, mean: np.ndarray) -> np.ndarray:
    """Sum of the products of centred coordinates, one keyed sum per matrix row."""
    dim = len(mean)

    def products(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) - mean
            total += rows.T @ rows
        ends = pa.array(np.arange(dim + 1, dtype=np.int32) * dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(total.reshape(-1)))], ["i", "row"]
        )

    parts = df.select(vx.as_double(F.col(vector)).alias("v")).mapInArrow(products, "i int, row array<double>")
    found = parts.groupBy("i").agg(vx.sums(F.col("row"), dim).alias("row")).collect()
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["i"])]).reshape(-1, dim)


def pca(df: DataFrame, vector: str = "vector", k: int = 2) -> tuple[DataFrame, list[float]]:
    """Coordinates on the first k principal axes of the centred vectors.

    Returns the rows with a ``coords`` array, and the explained variance ratios. An axis points
    to where its largest component is positive. Only the covariance matrix (dimension squared) reaches the driver.
    """
    dim = vx.dimension(df, vector)
    if not dim:
        return df.withColumn("coords", F.array().cast("array<double>")), []
    mean = np.array(df.agg(vx.means(F.col(vector), dim).alias("m")).first()["m"])
    values, axes = np.linalg.eigh(covariance(df.filter(F.col(vector).isNotNull()), vector, mean))
    first = np.argsort(-values, kind="stable")[:k]
    axes = axes[:, first] * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(dim)])[first]
    centred = F.zip_with(vx.as_double(F.col(vector)), F.array(*map(F.lit, mean.tolist())), lambda x, m: x - m)
    coords = tx.let(centred, lambda c: F.array(*[vx.dot(c, F.array(*map(F.lit, a.tolist()))) for a in axes.T]))
    total = values.sum()
    return df.withColumn("coords", coords), [float(v / total) if total > 0 else 0.0 for v in values[first]]
