"""The three jobs built from the operators: corpus, search, summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import chunking, classify, corpus, postings, retrieval, sparse, summarize, words
from ..sources.store import materialize


def processed_documents(
    raw: DataFrame, keep: Sequence[str] | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Processed documents, written once, and their one-row statistics.

    ``keep`` names the columns to write, all of them by default; what is not
    kept is not computed.
    """
    docs = corpus.build_corpus(raw, **options)
    docs = materialize(docs if keep is None else docs.select(*keep))
    return docs, corpus.corpus_stats(docs)


@dataclass
class SearchIndex:
    """A fitted index: chunk rows with both representations, and how to make them."""

    rows: DataFrame
    vocab: DataFrame
    n_docs: int
    model: PipelineModel
    options: dict
    lists: postings.Postings | None = None

    def postings(self) -> postings.Postings:
        """Posting lists of the rows, written when first asked for."""
        if self.lists is None:
            self.lists = postings.build(self.rows, "chunk_id")
        return self.lists

    def encode(self, queries: DataFrame) -> DataFrame:
        """Queries (query_id, text) as search expects them."""
        rows = retrieval.represent(queries, self.model, "text", **self.options)
        return materialize(rows.select("query_id", "embedding", "terms", "weights"))

    def search(self, queries: DataFrame, **options) -> DataFrame:
        return retrieval.search(self.encode(queries), self.rows, **options)


def fit_index(
    chunks: DataFrame, max_features: int = 2000, text: str = "chunk_text", **options
) -> SearchIndex:
    """Fit the vocabulary on all chunks and write the index.

    ``chunks`` needs chunk_id. They are read once for the vocabulary, which is
    the only shuffle, and once for the rows.
    """
    n_docs = chunks.count()
    vocab = materialize(
        retrieval.fit_vocabulary(chunks, n_docs, max_features, options.get("stop_words"), text)
    )
    model = sparse.vectorizer(vocab, n_docs)
    rows = retrieval.represent(chunks, model, text, **options)
    return SearchIndex(materialize(rows), vocab, n_docs, model, options)


def few_shot(
    questions: DataFrame,
    examples: DataFrame,
    make_model: Callable,
    intents: dict[str, str] | None = None,
    model: str = "model",
    retries: int = 0,
    **prompts,
) -> tuple[DataFrame, DataFrame]:
    """Answers of a plugged model to all questions, and their evaluation.

    ``questions`` needs question and label, ``examples`` pos and text. Returns the
    written rows with prompt, answer, latency_ms, failed and intent, and one row of metrics.
    """
    asked = classify.ask(
        classify.build_prompts(questions, examples, intents=intents, **prompts), make_model, retries=retries
    )
    known = None if intents is None else list(intents)
    rows = materialize(
        classify.normalize_answers(asked, "answer", known).withColumn("model", F.lit(model))
    )
    return rows, classify.evaluate_answers(rows, failed="failed")


@dataclass
class TextClassifier:
    """Mean word vectors, kernel features and a linear machine per class, fitted together."""

    words: DataFrame
    model: PipelineModel
    options: dict
    dim: int

    def encode(self, df: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
        """id and features of texts."""
        terms = df.select(id, tx.word_terms(F.coalesce(F.col(text), F.lit(""))).alias("lemmas"))
        means = words.doc_means(terms, self.words, "lemmas", id, oov="zero", dim=self.dim)
        return classify.rbf_features(means, **self.options) if self.options else means

    def predict(self, df: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
        """id and predicted label of texts."""
        return classify.predict(self.model, self.encode(df, text, id)).select(id, "predicted")


def train_text_classifier(
    df: DataFrame,
    word_vectors: DataFrame,
    text: str = "text",
    label: str = "label",
    id: str = "id",
    kernel: str = "rbf",
    validation_split: float = 0.2,
    gamma: float | None = None,
    features: int = 256,
) -> tuple[TextClassifier, DataFrame, DataFrame]:
    """From labelled texts to a classifier, its metrics and the prediction table.

    ``kernel`` is "rbf" (random Fourier features) or "linear"; ``gamma`` defaults to 1 /
    (dimension * variance) of the training vectors.
    """
    if kernel not in ("rbf", "linear"):
        raise ValueError("kernel must be 'rbf' or 'linear'")
    made = TextClassifier(word_vectors, None, {}, vx.dimension(word_vectors, "vector"))
    rows = materialize(made.encode(df, text, id))
    if kernel == "rbf":
        gamma = classify.default_gamma(rows) if gamma is None else gamma
        made.options = {"gamma": gamma, "features": features}
        rows = materialize(classify.rbf_features(rows, **made.options))
    labelled = rows.join(df.select(id, label), id)
    made.model, metrics = classify.train_metrics(labelled, label=label, id=id, validation_split=validation_split)
    predicted = classify.predict(made.model, rows).select(id, "predicted")
    table = classify.prediction_table(df.join(predicted, id), text, label, "predicted")
    return made, metrics, table


def chunk_table(docs: DataFrame, **options) -> DataFrame:
    """Chunk documents once and number the chunks; documents move once, chunks never.

    Options go to :func:`chunking.chunk`; ``lossless=True, min_document_chars=0`` indexes every word.
    """
    return chunking.number_in_order(materialize(chunking.chunk_in_order(docs, **options)))


def summaries(docs: DataFrame, text: str = "clean_text", id: str = "doc_id", **options) -> DataFrame:
    """Summaries weighted by the corpus' own term statistics, all terms included."""
    if options.get("summarizer"):
        return summarize.summarize(docs, text=text, id=id, **options)
    weights = materialize(summarize.term_weights(docs, text, id))
    return summarize.summarize(docs, summarize.scorer(weights), text=text, id=id, **options)
