"""Text embeddings: encoding, pooling, statistics, comparison of models."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions import vectors as vx
from . import topk, words
from .joins import lookup
from .positions import position_index

POOLINGS = ("cls", "mean", "max")
MASKED = -1e9
MIN_MASK = 1e-9
#: Words whose hash a worker remembers.
REMEMBERED = 500_000
remembered: dict[str, int] = {}


def truncate(tokens: Column, max_length: int = 512) -> Column:
    """The first ``max_length`` tokens, the window an encoder sees."""
    return F.slice(tokens, 1, max_length)


def hash_head(word: str) -> int:
    """The first nine hexadecimal digits of a word's md5, as :func:`vectors.hash_code` reads them."""
    found = remembered.get(word)
    if found is None:
        if len(remembered) >= REMEMBERED:
            remembered.clear()
        found = remembered[word] = int(md5(word.encode()).hexdigest()[:9], 16)
    return found


def hashed_rows(words: Column, dim: int) -> Column:
    """:func:`vectors.hashed` of word lists at unit length, in Arrow batches: a word is hashed once per worker."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def rows(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        named = lists.flatten().dictionary_encode()
        heads = np.array([hash_head(w) for w in named.dictionary.to_pylist()], np.int64)
        places = named.indices.to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(len(lists)), sizes) * dim + (heads >> 4)[places] % dim
        sums = np.bincount(at, np.where((heads & 15) >= 8, -1.0, 1.0)[places], len(lists) * dim).reshape(-1, dim)
        lengths = np.sqrt((sums**2).sum(axis=1))
        unit = (sums / np.where(lengths == 0, 1.0, lengths)[:, None]).astype(np.float32)
        ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dim)
        return pa.ListArray.from_arrays(ends, pa.array(unit.reshape(-1)))

    return rows(words)


def hashed_embedding(
    df: DataFrame,
    text: str,
    dim: int = 64,
    out: str = "embedding",
    max_length: int | None = None,
) -> DataFrame:
    """Signed feature hashing of the words of a text, scaled to unit length.

    Needs no weights. A text without words is zeros.
    """
    terms = tx.word_terms(F.col(text))
    if max_length is not None:
        terms = truncate(terms, max_length)
    return df.withColumn(out, hashed_rows(terms, dim))


def encode(
    df: DataFrame,
    text: str = "clean_text",
    make_encoder: Callable | None = None,
    dim: int = 64,
    batch_size: int = 32,
    normalize: bool = True,
    out: str = "embedding",
) -> DataFrame:
    """Embed texts in Arrow batches.

    ``make_encoder`` loads a model on the executor and returns a function from an
    array of texts to a float matrix; without it the hashing encoder is used.
    """
    if make_encoder is None:
        return hashed_embedding(df, text, dim, out)
    run = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    encoded = df.withColumn(out, run(F.col(text)))
    if not normalize:
        return encoded
    return encoded.withColumn(out, vx.l2_normalize(F.col(out)).cast("array<float>"))


def normalize_rows(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Scale each vector to unit length; zeros stay zeros."""
    return df.withColumn(vector, vx.l2_normalize(F.col(vector)))


def pool(
    df: DataFrame,
    how: str = "mean",
    id: str = "doc_id",
    pos: str = "pos",
    vector: str = "vector",
    mask: str | None = None,
    dim: int | None = None,
) -> DataFrame:
    """One vector per document from one row per token: id, embedding.

    ``cls`` takes the first token, ``mean`` and ``max`` the unmasked ones. All
    three combine inside the map tasks, so a document of any length is one
    partial row per task.
    """
    if how not in POOLINGS:
        raise ValueError(f"pooling must be one of {POOLINGS}")
    v = F.col(vector)
    if how == "cls":
        return df.groupBy(id).agg(F.min_by(vx.as_double(v), F.col(pos)).alias("embedding"))
    dim = vx.dimension(df, vector) if dim is None else dim
    keep = F.lit(True) if mask is None else F.col(mask).cast("boolean")
    if how == "max":
        return df.groupBy(id).agg(vx.maxima(v, dim, keep, MASKED).alias("embedding"))
    totals = df.groupBy(id).agg(
        vx.sums(v, dim, keep.cast("double")).alias("_sum"),
        F.greatest(F.sum(keep.cast("double")), F.lit(MIN_MASK)).alias("_n"),
    )
    return totals.select(id, F.transform("_sum", lambda x: x / F.col("_n")).alias("embedding"))


def similar_by_model(
    models: dict[str, DataFrame],
    k: int = 5,
    queries: DataFrame | None = None,
    id: str = "doc_id",
    vector: str = "embedding",
    **blocks,
) -> DataFrame:
    """The k nearest documents of each query document under every model."""
    if not models:
        raise ValueError("no model given")
    out = None
    for name, rows in models.items():
        wanted = rows if queries is None else rows.join(queries.select(id), id, "left_semi")
        sides = [topk.side(df, id, vector, None, None) for df in (wanted, rows)]
        found = topk.nearest(*sides, k, skip_self=True, **blocks)
        found = found.select(F.lit(name).alias("model"), *found.columns)
        out = found if out is None else out.unionByName(found)
    return out


def stats(df: DataFrame, model: str, vector: str = "embedding") -> DataFrame:
    """Shape, mean, population deviation, range and share of zeros of a matrix."""
    return (
        df.select(F.size(vector).alias("d"), F.explode(vx.as_double(F.col(vector))).alias("x"))
        .agg(
            F.max("d").alias("dimensionality"),
            F.count("x").alias("n_values"),
            F.avg("x").alias("mean"),
            F.stddev_pop("x").alias("std"),
            F.min("x").alias("min"),
            F.max("x").alias("max"),
            F.count(F.when(F.col("x") == 0, 1)).alias("n_zero"),
        )
        .select(
            F.lit(model).alias("model"),
            F.try_divide("n_values", "dimensionality").cast("long").alias("n_rows"),
            "dimensionality",
            "mean",
            "std",
            "min",
            "max",
            F.try_divide(F.col("n_zero") * 100.0, F.col("n_values")).alias("sparsity"),
        )
    )


def projection(
    df: DataFrame,
    id: str = "doc_id",
    vector: str = "embedding",
    n_docs: int | None = None,
    color_by: str | None = None,
) -> DataFrame:
    """2-D coordinates of the first ``n_docs`` rows: id, x, y, explained, category?.

    ``explained`` is the variance share of the two axes. A category column that
    does not exist is ignored.
    """
    rows = df if n_docs is None else df.orderBy(id).limit(n_docs)
    placed, explained = words.pca(rows, vector, 2)
    columns = [
        F.col(id),
        F.get("coords", F.lit(0)).alias("x"),
        F.get("coords", F.lit(1)).alias("y"),
        F.lit(float(sum(explained))).alias("explained"),
    ]
    if color_by and color_by in df.columns:
        columns.append(F.col(color_by).alias("category"))
    return placed.select(columns)


def color_points(points: DataFrame, id: str = "doc_id", category: str = "category") -> DataFrame:
    """Number the categories in order of first appearance and tag each point.

    Without a category column all points belong to group 0. Points stay one row
    each; only the short list of categories is numbered in one place.
    """
    if category not in points.columns:
        return points.withColumn("color", F.lit(0))
    order = (
        points.groupBy(category)
        .agg(F.min(id).alias("_first"))
        .select(category, (F.row_number().over(Window.orderBy("_first")) - 1).alias("color"))
    )
    return lookup(points, order, category)


def filename_index(df: DataFrame, id: str = "doc_id", filename: str = "filename") -> DataFrame:
    """Position of each document in id order: pos, filename, total_documents."""
    total = df.select(F.count(F.lit(1))).scalar()
    return position_index(df.select(id, filename), id).select(
        "pos", filename, total.alias("total_documents")
    )
