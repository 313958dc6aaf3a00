"""Bag-of-words and TF-IDF as long tables of postings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from ..sources.store import materialize
from . import postings as postings_index
from . import simjoin, topk
from .joins import salted_join


MAX_ROW_TERMS = 1_000_000


def postings(df: DataFrame, id: str = "doc_id", terms: str = "lemmas") -> DataFrame:
    """Term counts per document: id, term, tf.

    A document lies in one row, so its terms are counted there; nothing is
    shuffled.
    """
    return df.select(id, F.inline(tx.term_counts(F.col(terms))))


def row_count(df: DataFrame) -> Column:
    """Number of rows, as a scalar usable in other queries."""
    return df.select(F.count(F.lit(1))).scalar()


def at_least(bound: int | float, n_docs: Column) -> Column:
    """A document-frequency bound: an int counts, a float is a share of documents."""
    return F.lit(bound) if isinstance(bound, int) else F.lit(bound) * n_docs


def term_stats(posts: DataFrame) -> DataFrame:
    """Document and corpus count of every term: term, df, cf."""
    return posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def select_terms(
    stats: DataFrame,
    n_docs: int | Column,
    min_df: int | float,
    max_df: int | float,
    max_features: int,
) -> DataFrame:
    """Terms within the document-frequency bounds, the most frequent ones, numbered."""
    if isinstance(n_docs, int):
        n_docs = F.lit(n_docs)
    frequent = (
        stats.filter(
            (F.col("df") >= at_least(min_df, n_docs)) & (F.col("df") <= at_least(max_df, n_docs))
        )
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
    )
    return frequent.select(
        "term", (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"), "df", "cf"
    )


def vocabulary(
    posts: DataFrame,
    n_docs: int | Column,
    min_df: int | float = 2,
    max_df: int | float = 0.8,
    max_features: int = 2000,
) -> DataFrame:
    """Terms by document frequency, at most ``max_features`` by corpus count.

    Columns term, idx, df, cf; idx numbers the terms alphabetically. The result
    has at most ``max_features`` rows, which is what makes it safe to broadcast.
    """
    return select_terms(term_stats(posts), n_docs, min_df, max_df, max_features)


def bag_of_words(posts: DataFrame, vocab: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts of vocabulary terms: id, term, idx, weight."""
    return posts.join(F.broadcast(vocab), "term").select(
        id, "term", "idx", F.col("tf").cast("double").alias("weight")
    )


def idf(n_docs: Column) -> Column:
    """Smoothed inverse document frequency of the ``df`` column, plus one."""
    return F.log((n_docs + 1).cast("double") / (F.col("df") + 1)) + 1


def tfidf(
    posts: DataFrame, vocab: DataFrame, n_docs: int | Column, id: str = "doc_id"
) -> DataFrame:
    """TF-IDF weights with unit-length rows: id, term, idx, weight.

    A row's cells meet in one group, of at most the vocabulary's size, and its
    length is summed in index order: equal documents get equal weights to the
    last bit, however the data is partitioned.
    """
    if isinstance(n_docs, int):
        n_docs = F.lit(n_docs)
    known = F.broadcast(vocab.withColumn("idf", idf(n_docs)))
    cells = posts.join(known, "term").select(
        id, F.struct("idx", "term", (F.col("tf") * F.col("idf")).alias("w")).alias("cell")
    )
    rows = cells.groupBy(id).agg(F.sort_array(F.collect_list("cell")).alias("cells"))

    def scaled(length: Column) -> Column:
        return F.transform(
            "cells",
            lambda c: F.struct(
                c["term"].alias("term"), c["idx"].alias("idx"), (c["w"] / length).alias("weight")
            ),
        )

    squares = F.aggregate("cells", F.lit(0.0), lambda acc, c: acc + c["w"] * c["w"])
    return rows.select(id, F.inline(tx.let(F.sqrt(squares), scaled)))


EMPTY_ROWS = "SELECT *, filter(_terms, t -> false) AS _row FROM __THIS__"


def vectorizer(
    vocab: DataFrame, n_docs: int | None = None, unit_length: bool = True
) -> PipelineModel:
    """A fitted row-wise transformer from ``_terms`` to a sparse ``_row``.

    Without ``n_docs`` rows are counts, with it TF-IDF, of unit length unless
    told otherwise. The vocabulary is shipped to the tasks, so its size is
    checked; larger ones go through :func:`tfidf`, which joins. An empty one gives
    empty rows.
    """
    fitted = vocab.orderBy("idx").select("term", "df").limit(MAX_ROW_TERMS + 1).collect()
    if len(fitted) > MAX_ROW_TERMS:
        raise ValueError(f"vocabulary must have at most {MAX_ROW_TERMS} terms")
    if not fitted:
        return PipelineModel([SQLTransformer(statement=EMPTY_ROWS)])
    terms = [r["term"] for r in fitted]
    outputs = ["_counts", "_scaled", "_unit"][: 1 if n_docs is None else 3 if unit_length else 2]
    outputs[-1] = "_row"
    stages = [CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol=outputs[0])]
    if n_docs is not None:
        idfs = Vectors.dense([math.log((1 + n_docs) / (1 + r["df"])) + 1 for r in fitted])
        stages.append(ElementwiseProduct(scalingVec=idfs, inputCol=outputs[0], outputCol=outputs[1]))
        if unit_length:
            stages.append(Normalizer(p=2.0, inputCol=outputs[1], outputCol=outputs[2]))
    return PipelineModel(stages)


def vector_rows(df: DataFrame, model: PipelineModel, terms: str = "lemmas") -> DataFrame:
    """Add each document's sparse row as arrays ``terms`` and ``weights``.

    Rows are computed where the documents lie, without a shuffle. Unknown terms
    are ignored and a document without known ones gets an empty row.
    """
    present = F.coalesce(F.col(terms), F.array().cast("array<string>"))
    rows = model.transform(df.withColumn("_terms", present))
    if dict(rows.dtypes)["_row"].startswith("array"):  # nothing is known
        nothing = {"terms": "array<int>", "weights": "array<double>"}
        return rows.drop("_terms", "_row").withColumns({c: F.array().cast(t) for c, t in nothing.items()})
    return (
        rows.withColumn("_cells", F.unwrap_udt("_row"))
        .withColumn("terms", F.col("_cells.indices"))
        .withColumn("weights", F.col("_cells.values"))
        .drop("_terms", "_counts", "_scaled", "_row", "_cells")
    )


def unpack(rows: DataFrame, vocab: DataFrame, id: str = "doc_id") -> DataFrame:
    """Sparse rows as a long table: id, term, idx, weight."""
    cells = rows.select(
        id,
        F.inline(
            F.zip_with(
                "terms", "weights", lambda t, w: F.struct(t.alias("idx"), w.alias("weight"))
            )
        ),
    )
    return cells.join(F.broadcast(vocab.select("idx", "term")), "idx").select(
        id, "term", "idx", "weight"
    )


def matrix_stats(weights: DataFrame, n_docs: Column, vocab: DataFrame) -> DataFrame:
    """Vocabulary size, shape, non-zeros and the moments of the dense matrix.

    Zeros are counted, not stored: the mean and the population deviation follow
    from the sums over the postings. Ratios are null for an empty matrix.
    """
    cells = F.col("n_docs") * F.col("n_terms")
    mean = F.try_divide(F.col("s"), cells)
    share = F.try_divide(F.col("nnz") * 100.0, cells)
    has_zero = F.col("nnz") < cells
    zero = F.lit(0.0)
    return (
        weights.agg(
            F.count(F.when(F.col("weight") != 0, 1)).alias("nnz"),
            F.coalesce(F.sum("weight"), F.lit(0.0)).alias("s"),
            F.coalesce(F.sum(F.col("weight") * F.col("weight")), F.lit(0.0)).alias("s2"),
            F.min("weight").alias("lo"),
            F.max("weight").alias("hi"),
        )
        .withColumn("n_docs", n_docs)
        .withColumn("n_terms", row_count(vocab))
        .select(
            "n_docs",
            "n_terms",
            "nnz",
            share.alias("density_pct"),
            (F.lit(100.0) - share).alias("sparsity_pct"),
            F.when(has_zero, F.least(F.col("lo"), zero)).otherwise(F.col("lo")).alias("min"),
            F.when(has_zero, F.greatest(F.col("hi"), zero)).otherwise(F.col("hi")).alias("max"),
            mean.alias("mean"),
            F.sqrt(F.greatest(F.try_divide(F.col("s2"), cells) - mean * mean, zero)).alias("std"),
        )
    )


def top_terms(weights: DataFrame, n: int = 20) -> DataFrame:
    """Terms by column sum: term, score."""
    return (
        weights.groupBy("term")
        .agg(F.sum("weight").alias("score"))
        .orderBy(F.round("score", topk.DIGITS).desc(), "term")
        .limit(n)
    )


def top_terms_of(
    representation: str, bow: DataFrame | None, weighted: DataFrame | None, n: int = 20
) -> DataFrame:
    """Top terms of ``"bow"``, or of TF-IDF under any other name; both must be fitted."""
    weights = bow if representation == "bow" else weighted
    if weights is None:
        raise ValueError(f"no fitted weights for {representation!r}")
    return top_terms(weights, n)


def compare_top_terms(bow: DataFrame, weighted: DataFrame, n: int = 15) -> DataFrame:
    """The top terms of two representations side by side, by rank."""

    def ranked(weights: DataFrame, label: str) -> DataFrame:
        order = Window.orderBy(F.round("score", topk.DIGITS).desc(), "term")
        return top_terms(weights, n).select(
            F.row_number().over(order).alias("rank"),
            F.col("term").alias(f"{label}_term"),
            F.col("score").alias(f"{label}_score"),
        )

    return ranked(bow, "bow").join(ranked(weighted, "tfidf"), "rank", "full_outer")


def similar(
    rows: DataFrame,
    n: int = 5,
    queries: DataFrame | None = None,
    id: str = "doc_id",
    method: str = "blocks",
    **blocks,
) -> DataFrame:
    """The n documents nearest by cosine to each query document, never itself.

    ``rows`` come from :func:`vector_rows`; ``queries`` holds the ids to look up,
    all of them by default. ``method`` is "blocks", or "postings" where the lists of the
    queries' terms are few against the corpus. Returns query_id, rank, item_id, score.
    """
    if method not in ("blocks", "postings"):
        raise ValueError("method must be 'blocks' or 'postings'")
    if method == "postings":
        unit = materialize(rows.select(id, "terms", vx.l2_normalize(F.col("weights")).alias("weights")))
        wanted = unit if queries is None else unit.join(queries.select(id), id, "left_semi")
        return postings_index.search(wanted, postings_index.build(unit, id), n, id, skip_self=True)
    wanted = rows if queries is None else rows.join(queries.select(id), id, "left_semi")
    sides = [topk.side(df, id, None, "terms", "weights") for df in (wanted, rows)]
    return topk.nearest(*sides, n, by="lexical", skip_self=True, **blocks)


def content_key() -> Column:
    """Equal for rows whose terms and weights agree at the compared precision."""
    weights = F.transform("weights", lambda w: F.round(w, topk.DIGITS))
    return F.sha2(F.to_json(F.struct("terms", weights.alias("weights"))), 256)


def copy_groups(rows: DataFrame, id: str = "doc_id") -> DataFrame:
    """Documents with identical rows: id, group_id (the smallest id), copies."""
    marked = rows.select(id, content_key().alias("_content"))
    groups = marked.groupBy("_content").agg(
        F.min(id).alias("group_id"), F.count(F.lit(1)).alias("copies")
    )
    return salted_join(marked, groups, "_content", id, how="inner").select(id, "group_id", "copies")


def similarity_edges(
    rows: DataFrame, min_cosine: float, id: str = "doc_id", **options
) -> DataFrame:
    """The similarity matrix at or above ``min_cosine``, without writing it out twice.

    Identical rows are one vertex, named by the smallest id and weighted by the
    number of copies, so a large set of copies yields no pairs among itself;
    :func:`copy_groups` lists its members. ``options`` go to :func:`simjoin.pairs_at_least`.
    Returns left_id, right_id, cosine, left_copies, right_copies.
    """
    vertices = materialize(
        rows.groupBy(content_key().alias("_content"))
        .agg(
            F.min(id).alias(id),
            F.min_by(F.struct("terms", "weights"), id).alias("_row"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select(id, "_row.terms", "_row.weights", "copies")
    )
    edges = simjoin.pairs_at_least(
        topk.side(vertices, id, None, "terms", "weights"), min_cosine, **options
    )
    left = vertices.select(F.col(id).alias("left_id"), F.col("copies").alias("left_copies"))
    right = vertices.select(F.col(id).alias("right_id"), F.col("copies").alias("right_copies"))
    return (
        edges.join(left, "left_id")
        .join(right, "right_id")
        .select("left_id", "right_id", "cosine", "left_copies", "right_copies")
    )


def similarity_links(rows: DataFrame, min_cosine: float, id: str = "doc_id", **options) -> DataFrame:
    """Every document with its class of identical rows and what that is linked to.

    Classes are compared as in :func:`similarity_edges`; links are counted where they are found, so
    their number may grow with the square of the rows and nothing that is moved or written does.
    Returns id, class_id (the smallest id of the class), copies, links (other classes whose cosine
    reaches ``min_cosine``) and total (the sum of these cosines, each at the compared precision).
    """
    marked = rows.select(id, "terms", "weights", content_key().alias("_content"))
    vertices = materialize(
        marked.groupBy("_content")
        .agg(
            F.min(id).alias("class_id"),
            F.min_by(F.struct("terms", "weights"), id).alias("_row"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select("_content", "class_id", F.col("_row.terms").alias("terms"), F.col("_row.weights").alias("weights"), "copies")
        .withColumn("_vertex", F.monotonically_increasing_id())
    )
    links = simjoin.links_at_least(topk.side(vertices, "_vertex", None, "terms", "weights"), min_cosine, **options)
    classes = vertices.join(links.withColumnRenamed("id", "_vertex"), "_vertex", "left").select(
        "_content",
        "class_id",
        "copies",
        F.coalesce("links", F.lit(0)).alias("links"),
        (F.coalesce("total", F.lit(0)) / 10.0**topk.DIGITS).alias("total"),
    )
    members = marked.select(id, "_content")
    return salted_join(members, materialize(classes), "_content", id, how="inner").drop("_content")


def retrieval_words(text: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Words of two characters or more without stop words."""
    return tx.drop_stop_words(tx.word_terms(text, 2), stop_words)


def word_pairs(words: Column, among: Sequence[str] | None = None) -> Column:
    """Bigrams in order; with ``among`` only those of two listed words."""
    if among is not None:
        listed = list(among)
        words = F.transform(words, lambda w: F.when(w.isin(listed), w))
    return F.filter(tx.ngrams(words, 2), lambda g: g.isNotNull())


def with_retrieval_terms(
    df: DataFrame,
    text: str,
    out: str = "terms_list",
    stop_words: Sequence[str] | None = None,
    among: Sequence[str] | None = None,
) -> DataFrame:
    """Add the words of a text and the bigrams formed from them."""
    words = retrieval_words(F.col(text), stop_words)
    return df.withColumn(out, tx.let(words, lambda w: F.concat(w, word_pairs(w, among))))
