"""Exact nearest rows of two large sides: an index of cells that are skipped where they cannot matter.

A bounded sample of the corpus gives centroids; every row belongs to the nearest one's
cell. A cell knows its number of rows and its radius, the largest distance of a row from the
centroid. By the triangle inequality no row of a cell scores more than ``q . centroid +
|q| * radius``. A query is answered first by its nearest cells, as many as hold k rows; only
cells whose bound reaches the k-th score found there are met after that.

Cells larger than ``block_rows`` are cut into blocks, and the queries of a much asked cell into
groups, so that every meeting is of bounded size. Corpus rows move once to be laid out by
cell, queries once per cell that they meet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import materialize
from . import topk

#: Cells, and rows that the centroids are fitted on, at most; coordinates of all centroids.
MAX_CELLS, SAMPLE_ROWS, MAX_VALUES = 4096, 16_384, 4_000_000
LLOYD_STEPS = 4
#: Queries that meet one block of a cell in one task.
QUERY_GROUP = 4096
SLACK = 2 * 10.0**-topk.DIGITS


@dataclass
class Cells:
    """Centroids with the rows and radius of their cells, and the corpus with its cell numbers."""

    centroids: np.ndarray
    counts: np.ndarray
    radii: np.ndarray
    rows: DataFrame


def vectors_of(batch, cosine: bool) -> np.ndarray:
    """The dense column of a batch; unit rows for a cosine."""
    flat = batch.column("dense").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(batch), -1) if len(batch) else np.zeros((0, 1))
    return topk.unit_rows(rows) if cosine else rows


def nearest_centroid(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1)[None, :] - 2 * rows @ centroids.T, axis=1)


def fit_centroids(corpus: DataFrame, n: int, cosine: bool) -> np.ndarray:
    """Means of a sample's clusters, about as many as the root of the corpus."""
    sample = corpus.select("dense").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toArrow()
    rows = vectors_of(sample.combine_chunks().to_batches()[0], cosine) if sample.num_rows else np.zeros((1, 1))
    firsts = rows[np.sort(np.unique(rows, axis=0, return_index=True)[1])]
    cells = max(1, min(MAX_CELLS, math.ceil(math.sqrt(n)), len(firsts), MAX_VALUES // rows.shape[1]))
    centroids = firsts[:cells]
    for _ in range(LLOYD_STEPS):
        own = nearest_centroid(rows, centroids)
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def build(corpus: DataFrame, cosine: bool = False) -> Cells:
    """Assign every row of ``corpus`` (a :func:`topk.side` with dense vectors) to its cell; written."""
    n = corpus.count()
    centroids = fit_centroids(corpus, n, cosine)

    def assigned(batches):
        for batch in batches:
            for start in range(0, len(batch), topk.SLICE_ROWS):
                part = batch.slice(start, topk.SLICE_ROWS)
                rows = vectors_of(part, cosine)
                own = nearest_centroid(rows, centroids)
                away = np.sqrt(((rows - centroids[own]) ** 2).sum(axis=1))
                yield part.append_column("cell", pa.array(own, pa.int32())).append_column("away", pa.array(away))

    kinds = ", ".join(f"{name} {kind}" for name, kind in corpus.dtypes)
    rows = materialize(corpus.mapInArrow(assigned, f"{kinds}, cell int, away double"))
    counts, radii = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).collect():
        counts[r["cell"]], radii[r["cell"]] = r["n"], r["away"] + 1e-9
    return Cells(centroids, counts, radii, rows)


def asked_cells(queries: DataFrame, cells: Cells, k: int, cosine: bool, floors: bool) -> DataFrame:
    """id and cell of the cells that a query meets: first the nearest ones that hold k rows, then
    (``floors``: the queries have a column floor) all others whose bound reaches it."""
    centroids, counts, radii = cells.centroids, cells.counts, cells.radii

    def asked(batches):
        for batch in batches:
            for start in range(0, len(batch), topk.SLICE_ROWS):
                part = batch.slice(start, topk.SLICE_ROWS)
                rows = vectors_of(part, cosine)
                score = np.where(counts > 0, rows @ centroids.T, -np.inf)
                order = np.argsort(-score, axis=1, kind="stable")
                before = np.cumsum(counts[order], axis=1) - counts[order]
                first = np.zeros(score.shape, bool)
                np.put_along_axis(first, order, before < k, axis=1)
                wanted = first & (counts > 0)
                if floors:
                    bound = score + np.sqrt((rows**2).sum(axis=1))[:, None] * radii[None, :]
                    floor = part.column("floor").to_numpy(zero_copy_only=False)
                    wanted = ~first & (counts > 0) & (bound >= floor[:, None] - SLACK)
                row, cell = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)), pa.array(cell, pa.int32())], ["id", "cell"]
                )

    kind = queries.schema["id"].dataType.simpleString()
    return queries.select("id", "dense", *(["floor"] if floors else [])).mapInArrow(asked, f"id {kind}, cell int")


def answered(requests: DataFrame, queries: DataFrame, cells: Cells, k: int, rule: tuple, block_rows: int) -> DataFrame:
    """The best k rows of every cell block for each query that asks for it."""
    sizes = [(i, max(1, math.ceil(c / block_rows))) for i, c in enumerate(cells.counts.tolist())]
    spark = queries.sparkSession
    # One row per cell: at most MAX_CELLS.
    blocks = F.broadcast(spark.createDataFrame(sizes, "cell int, blocks int"))
    groups = requests.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_GROUP).cast("int").alias("groups"))
    plan = F.broadcast(materialize(groups.join(blocks, "cell")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    columns = [c for c in queries.columns if c != "floor"]
    left = requests.join(queries.select(columns), "id").join(plan, "cell")
    left = left.withColumn("block", every("blocks")).select("cell", "block", own("groups").alias("grp"), *columns)
    right = cells.rows.join(plan, "cell").withColumn("grp", every("groups"))
    # Fresh aliases keep the two sides apart when they are the same rows.
    right = right.select("cell", own("blocks").alias("block"), "grp", *columns)
    left, right = (df.select([F.col(c).alias(c) for c in df.columns]) for df in (left, right))
    kinds = [topk.arrow_id(df, "id") for df in (queries, cells.rows)]
    shape = [("query_id", kinds[0]), ("rank", pa.int32()), ("item_id", kinds[1]), ("dense", pa.float64()), ("lexical", pa.float64())]
    empty = pa.schema(shape).empty_table()

    def meet(asking: pa.Table, held: pa.Table) -> pa.Table:
        stream = iter(topk.sliced(held.select(columns), topk.SLICE_ROWS))
        return next(topk.meet(topk.sliced(asking.select(columns), topk.SLICE_ROWS), stream, *rule), empty)

    names = [df.schema["id"].dataType.simpleString() for df in (queries, cells.rows)]
    keys = ("cell", "block", "grp")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        meet, f"query_id {names[0]}, rank int, item_id {names[1]}, dense double, lexical double"
    )


def best(
    queries: DataFrame, corpus: DataFrame, k: int, cosine: bool = False, skip_self: bool = False, block_rows: int = topk.BLOCK_ROWS
) -> DataFrame:
    """The best k corpus rows per query by dense score: query_id, rank, item_id, dense, lexical.

    Both sides come from :func:`topk.side` and carry the same columns.
    """
    cells = build(corpus, cosine)
    if not cells.counts.any():
        kinds = [df.schema["id"].dataType.simpleString() for df in (queries, corpus)]
        shape = f"query_id {kinds[0]}, rank int, item_id {kinds[1]}, dense double, lexical double"
        return queries.sparkSession.createDataFrame([], shape)
    rule = (k, "dense", cosine, skip_self)
    tie = F.col("item_id")
    first = materialize(asked_cells(queries, cells, k + skip_self, cosine, False))
    found = materialize(topk.cut(answered(first, queries, cells, k, rule, block_rows), F.col("dense"), k, tie))
    floors = found.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("dense")).otherwise(F.lit(float("-inf"))).alias("floor")
    )
    named = floors.withColumnRenamed("query_id", "id")
    held = queries.join(named, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    others = materialize(asked_cells(held, cells, k + skip_self, cosine, True))
    more = answered(others, queries, cells, k, rule, block_rows)
    columns = ["query_id", "item_id", "dense", "lexical"]
    every = found.select(columns).union(more.select(columns))
    return topk.cut(every, F.col("dense"), k, tie).select("query_id", "rank", "item_id", "dense", "lexical")
