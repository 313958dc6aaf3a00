"""Dense, lexical and hybrid search over a chunk index, and its evaluation.

An index row holds chunk_id, filename, chunk_text, flags, embedding and the
sparse TF-IDF row (terms, weights). A query row holds query_id, embedding, terms
and weights. All queries of a batch are answered by one pass over the index.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.constants import SCOPE_ALL, SCOPE_ONE, STATS_SCOPE_ALL
from ..sources.store import materialize
from . import contextual, postings, sparse, topk
from .joins import is_small, salted_join

METHODS = ("sbert", "tfidf", "hybrid")
OVERFETCH = 3
PREVIEW_CHARS = 150
MAX_LISTED_WORDS = 10_000


def fit_vocabulary(
    chunks: DataFrame,
    n_docs: int,
    max_features: int = 2000,
    stop_words=None,
    text: str = "chunk_text",
    id: str = "chunk_id",
) -> DataFrame:
    """Vocabulary of words and bigrams over all chunks, also for scoped searches.

    A bigram is no more frequent than either of its words (the Apriori property),
    so once the words alone fill the vocabulary, only bigrams of two words at or
    above the last one's count can enter it. The others are never counted; the
    result is the same.
    """
    words = sparse.retrieval_words(F.col(text), stop_words)
    stats = materialize(
        sparse.term_stats(sparse.postings(chunks.select(id, words.alias("_words")), id, "_words"))
    )
    best = sparse.select_terms(stats, n_docs, 1, 1.0, max_features)
    full = best.agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("floor")).first()
    among = None
    if full["n"] == max_features:
        frequent = stats.filter(F.col("cf") >= full["floor"]).select("term")
        if is_small(frequent, MAX_LISTED_WORDS):
            among = [r["term"] for r in frequent.collect()]
    pairs = chunks.select(
        id, tx.let(words, lambda w: sparse.word_pairs(w, among)).alias("_pairs")
    )
    pair_stats = sparse.term_stats(sparse.postings(pairs, id, "_pairs"))
    both = best.select("term", "df", "cf").unionByName(pair_stats)
    return sparse.select_terms(both, n_docs, 1, 1.0, max_features)


def represent(
    df: DataFrame,
    model: PipelineModel,
    text: str,
    dim: int = 64,
    make_encoder=None,
    stop_words=None,
) -> DataFrame:
    """Add both representations of a text: embedding, terms and weights.

    One map-only pass, the same for chunks and for queries. Only bigrams of words
    that the vocabulary pairs are formed.
    """
    vocabulary = model.stages[0].vocabulary
    among = sorted({word for term in vocabulary if " " in term for word in term.split(" ")})
    terms = sparse.with_retrieval_terms(df, text, "_grams", stop_words, among)
    rows = sparse.vector_rows(terms, model, "_grams").drop("_grams")
    return contextual.encode(rows, text, make_encoder, dim)


def scoped(index: DataFrame, filename: str | None) -> DataFrame:
    """Chunks of one file; the whole index when no name (or an empty one) is given."""
    return index.filter(F.col("filename") == filename) if filename else index


def truthy(df: DataFrame, column: str) -> Column:
    """A flag as a boolean; numbers are true unless zero, missing values false."""
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def reweigh(df: DataFrame, score: Column, intent_weights: dict[str, float] | None) -> Column:
    """Multiply the score by the weight of every flag that is set.

    Flags the table lacks are ignored. Negative scores move away from zero too.
    """
    for column, weight in (intent_weights or {}).items():
        if column in df.columns:
            score = F.when(truthy(df, column), score * F.lit(float(weight))).otherwise(score)
    return score


def search_dense(queries: DataFrame, index: DataFrame, k: int = 5, **blocks) -> DataFrame:
    """Top k by inner product of the embeddings."""
    found = topk.best(
        topk.side(queries, "query_id", "embedding", None, None),
        topk.side(index, "chunk_id", "embedding", None, None),
        k,
        **blocks,
    )
    return found.select(
        "query_id", "rank", F.col("item_id").alias("chunk_id"), F.col("dense").alias("score")
    )


def search_lexical(
    queries: DataFrame, index: DataFrame, k: int = 5, lists: postings.Postings | None = None, **blocks
) -> DataFrame:
    """Top k by TF-IDF cosine; chunks without a common term fill up with score 0.

    With ``lists`` (:func:`postings.build` of the same rows) the work follows the posting lists
    of the queries' terms; without, every row is read.
    """
    if lists is not None:
        return postings.search(queries, lists, k).withColumnRenamed("item_id", "chunk_id")
    found = topk.best(
        topk.side(queries, "query_id", None, "terms", "weights"),
        topk.side(index, "chunk_id", None, "terms", "weights"),
        k,
        by="lexical",
        **blocks,
    )
    return found.select(
        "query_id", "rank", F.col("item_id").alias("chunk_id"), F.col("lexical").alias("score")
    )


def search_hybrid(
    queries: DataFrame,
    index: DataFrame,
    k: int = 5,
    alpha: float = 0.7,
    intent_weights: dict[str, float] | None = None,
    **blocks,
) -> DataFrame:
    """Re-score the best 3k dense candidates; ties keep the dense order.

    The lexical scores of the candidates come out of the same pass.
    """
    found = topk.best(
        topk.side(queries, "query_id", "embedding", "terms", "weights"),
        topk.side(index, "chunk_id", "embedding", "terms", "weights"),
        OVERFETCH * k,
        **blocks,
    ).select(
        "query_id",
        F.col("rank").alias("dense_rank"),
        F.col("item_id").alias("chunk_id"),
        "dense",
        "lexical",
    )
    return rescored(found, queries, index, k, alpha, intent_weights)


def rescored(
    found: DataFrame, queries: DataFrame, index: DataFrame, k: int, alpha: float = 0.7, intent_weights: dict[str, float] | None = None
) -> DataFrame:
    """The best k of dense candidates (query_id, dense_rank, chunk_id, dense, lexical) by the mixed score."""
    flags = [c for c in (intent_weights or {}) if c in index.columns]
    if flags:
        found = meet_chunks(found, index.select("chunk_id", *flags), queries)
    mixed = F.col("dense") * F.lit(alpha) + F.col("lexical") * F.lit(1 - alpha)
    scored = found.withColumn("score", reweigh(found, mixed, intent_weights))
    return topk.cut(scored, F.col("score"), k, F.col("dense_rank")).select(
        "query_id", "rank", "chunk_id", "score"
    )


def meet_chunks(ranked: DataFrame, chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Join a few rows per query to the chunk table.

    With a checked number of queries the ranked rows are broadcast, so the chunk
    table is scanned but not shuffled. Otherwise chunks that many queries found
    are salted.
    """
    if is_small(queries, topk.MAX_BROADCAST_ROWS):
        return chunks.join(F.broadcast(ranked), "chunk_id")
    return salted_join(ranked, chunks, "chunk_id", "query_id", how="inner")


def present(
    ranked: DataFrame, chunks: DataFrame, queries: DataFrame, scope: str
) -> DataFrame:
    """Attach file, preview, text, scope label and flags to ranked chunk ids."""

    def flag(name: str) -> Column:
        return (F.col(name) if name in chunks.columns else F.lit(False)).alias(name)

    shown = chunks.select(
        "chunk_id",
        "filename",
        F.concat(F.left("chunk_text", F.lit(PREVIEW_CHARS)), F.lit("...")).alias("text_preview"),
        F.col("chunk_text").alias("full_text"),
        flag("is_warning"),
        flag("is_procedure"),
    )
    return meet_chunks(ranked, shown, queries).select(
        "query_id",
        "rank",
        "chunk_id",
        "filename",
        "text_preview",
        "full_text",
        "score",
        F.lit(scope).alias("search_scope"),
        "is_warning",
        "is_procedure",
    )


def search(
    queries: DataFrame,
    index: DataFrame,
    filename: str | None = None,
    k: int = 5,
    method: str = "hybrid",
    alpha: float = 0.7,
    intent_weights: dict[str, float] | None = None,
    **blocks,
) -> DataFrame:
    """Answer every query with its k best chunks, over all files or one.

    An unknown file gives an empty result with the full schema.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    rows = scoped(index, filename)
    if method == "sbert":
        ranked = search_dense(queries, rows, k, **blocks)
    elif method == "tfidf":
        ranked = search_lexical(queries, rows, k, **blocks)
    else:
        ranked = search_hybrid(queries, rows, k, alpha, intent_weights, **blocks)
    scope = SCOPE_ONE.format(filename) if filename else SCOPE_ALL
    return present(ranked, rows, queries, scope)


def compare_methods(queries: DataFrame, index: DataFrame, k: int = 5, **options) -> DataFrame:
    """The three methods side by side: method, query_id, rank, chunk_id, score.

    A query set of checked size meets the index once for all three.
    """
    sides = [topk.side(df, id, "embedding", "terms", "weights") for df, id in ((queries, "query_id"), (index, "chunk_id"))]
    both = topk.best_both(*sides, OVERFETCH * k, k)
    if both is not None:
        both = materialize(both.withColumnRenamed("item_id", "chunk_id"))
        dense, lexical = both.filter("by = 'dense'"), both.filter("by = 'lexical'").withColumn("score", F.col("lexical"))
        near = dense.filter(F.col("rank") <= k).withColumn("score", F.col("dense"))
        mixed = rescored(dense.withColumnRenamed("rank", "dense_rank"), queries, index, k, **options)
        tagged = [
            df.select(F.lit(m).alias("method"), "query_id", "rank", "chunk_id", "score")
            for m, df in (("sbert", near), ("tfidf", lexical), ("hybrid", mixed))
        ]
        return tagged[0].union(tagged[1]).union(tagged[2])
    parts = {
        "sbert": search_dense(queries, index, k),
        "tfidf": search_lexical(queries, index, k),
        "hybrid": search_hybrid(queries, index, k, **options),
    }
    out = None
    for method, ranked in parts.items():
        tagged = ranked.select(F.lit(method).alias("method"), *ranked.columns)
        out = tagged if out is None else out.unionByName(tagged)
    return out


def available_files(chunks: DataFrame) -> DataFrame:
    return chunks.select("filename").distinct().orderBy("filename")


def chunk_stats(chunks: DataFrame, filename: str | None = None) -> DataFrame:
    """Chunks, files, mean characters and flag counts, over all files or one."""
    rows = scoped(chunks, filename)

    def count(name: str) -> Column:
        if name not in chunks.columns:
            return F.lit(0).cast("long")
        return F.count(F.when(truthy(chunks, name), 1))

    return rows.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_distinct("filename").alias("unique_files"),
        F.avg(F.length("chunk_text")).alias("avg_chunk_length"),
        count("is_warning").alias("warnings_detected"),
        count("is_procedure").alias("procedures_detected"),
    ).select(
        F.lit(SCOPE_ONE.format(filename) if filename else STATS_SCOPE_ALL).alias("scope"), "*"
    )


def chunk_stats_by_file(chunks: DataFrame) -> DataFrame:
    """The statistics of every file at once."""
    return chunks.groupBy("filename").agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.avg(F.length("chunk_text")).alias("avg_chunk_length"),
        F.count(F.when(truthy(chunks, "is_warning"), 1)).alias("warnings_detected"),
        F.count(F.when(truthy(chunks, "is_procedure"), 1)).alias("procedures_detected"),
    )


def evaluate(
    results: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    k: int = 10,
    miss_rank: int | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """MRR, Hit and NDCG at k, and the mean rank of the first relevant chunk.

    ``results`` are ranked (query_id, chunk_id, rank), ``qrels`` the relevant
    (query_id, chunk_id), ``queries`` every query asked. A query without a hit
    counts 0 towards MRR, or ``1 / miss_rank`` when that is given. The mean rank
    covers queries with a hit, and is k when there is none. ``by`` names columns
    of ``results``, such as the method, to report separately.
    """
    by = list(by)
    relevant = qrels.select("query_id", "chunk_id").distinct()
    ideal = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).select(
        "query_id",
        F.aggregate(
            F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(k)).cast("int")),
            F.lit(0.0),
            lambda acc, r: acc + F.lit(1.0) / F.log2(r.cast("double") + 1),
        ).alias("_ideal"),
    )
    asked = queries.select("query_id").distinct()
    if by:
        # Every reported group answers every query; the groups are few.
        groups = results.select(*by).distinct()
        names = groups.agg(F.collect_set(F.struct(*by))).scalar()
        asked = asked.select("query_id", F.inline(names))
    gains = (
        results.filter(F.col("rank") <= k)
        .join(relevant, ["query_id", "chunk_id"], "left_semi")
        .groupBy(*by, "query_id")
        .agg(
            F.min("rank").alias("_first"),
            F.sum(F.lit(1.0) / F.log2(F.col("rank").cast("double") + 1)).alias("_dcg"),
        )
    )
    rows = asked.join(gains, [*by, "query_id"], "left").join(ideal, "query_id", "left")
    miss = F.lit(0.0) if miss_rank is None else F.lit(1.0 / miss_rank)
    first = F.col("_first")

    def hit(at: int) -> Column:
        return F.avg(F.when(first <= at, 1.0).otherwise(0.0)).alias(f"hit_{at}")

    metrics = [
        F.avg(F.coalesce(F.lit(1.0) / first, miss)).alias("mrr"),
        *[hit(at) for at in sorted({1, min(5, k), k})],
        F.avg(F.coalesce(F.try_divide("_dcg", "_ideal"), F.lit(0.0))).alias("ndcg"),
        F.coalesce(F.avg(first), F.lit(float(k))).alias("avg_rank_first_relevant"),
        F.count(F.lit(1)).alias("total_queries"),
    ]
    return rows.groupBy(*by).agg(*metrics) if by else rows.agg(*metrics)


