"""Weighted sums of word vectors per key, without a vector for every (key, word).

The keys are cut into parts, and the vectors that a part's edges name into blocks of bounded size. A part's
edges meet each of its blocks in turn, as a product inside one task; what leaves the task is one sum per key and
block. The shuffle carries the edges, which are two short values each, and for each part the vectors that its
edges name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..sources.store import materialize
from .topk import arrow_id

#: Vector coordinates of one block, and edges of one part.
BLOCK_VALUES = 4_000_000
PART_EDGES = 2_000_000


def weighted_sums(
    edges: DataFrame,
    vectors: DataFrame,
    dim: int,
    key: str,
    word: str = "word",
    weight: str = "weight",
    vector: str = "vector",
    block_values: int = BLOCK_VALUES,
    part_edges: int = PART_EDGES,
) -> DataFrame:
    """Per key with a known word: key, sums (of weight times vector) and n (the weights of known words).

    ``vectors`` has one row per word. Edges of unknown words, and of null keys or words, add nothing.
    """
    rows = edges.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(word).alias("w"), F.col(weight).cast("double").alias("x")
    )
    rows = materialize(rows)
    known = vectors.select(F.col(word).alias("w"), F.col(vector).alias("v"))
    cores = edges.sparkSession.sparkContext.defaultParallelism
    parts = max(math.ceil(rows.count() / part_edges), cores)
    rows = rows.filter("w IS NOT NULL")
    part = F.pmod(F.xxhash64("k"), F.lit(parts)).cast("int").alias("part")
    # At most a row per edge: copies for every part would grow with the square of the input. A block is cut from
    # the vectors of its part, as a key leaves a sum in each of its blocks.
    named = materialize(rows.select("w", part).distinct().join(known.select("w"), "w", "left_semi"))
    blocks = max(1, math.ceil(named.count() / parts * max(dim, 1) / block_values))
    block = F.pmod(F.xxhash64("w"), F.lit(blocks)).cast("int").alias("block")
    left = rows.select("k", "w", "x", block, part)
    # Fresh aliases keep apart what comes from the same edges.
    right = known.join(named, "w").select(F.col("w").alias("w"), "v", block, F.col("part").alias("part"))
    empty = pa.schema([("k", arrow_id(rows, "k")), ("sums", pa.list_(pa.float64())), ("n", pa.float64())]).empty_table()

    def meet(edges: pa.Table, words: pa.Table) -> pa.Table:
        if not edges.num_rows or not words.num_rows:
            return empty
        at = pc.index_in(edges.column("w"), value_set=words.column("w").combine_chunks())
        edges = edges.append_column("at", at).filter(pc.is_valid(at)).combine_chunks()
        if not edges.num_rows:
            return empty
        matrix = words.column("v").combine_chunks().flatten().to_numpy().astype(float).reshape(words.num_rows, -1)
        named = edges.column("k").combine_chunks().dictionary_encode()
        keys, places = named.dictionary, named.indices.to_numpy()
        order = np.argsort(places, kind="stable")
        places, at, x = places[order], edges.column("at").to_numpy()[order].astype(np.intp), edges.column("x").to_numpy()[order]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(places) != 0]))
        sums = np.zeros((len(keys), matrix.shape[1]))
        # A coordinate at a time: its sums run over neighbouring numbers.
        for i, line in enumerate(np.ascontiguousarray(matrix.T)):
            sums[places[starts], i] = np.add.reduceat(line[at] * x, starts)
        ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * matrix.shape[1])
        lists = pa.ListArray.from_arrays(ends, pa.array(sums.reshape(-1)))
        return pa.table({"k": keys, "sums": lists, "n": pa.array(np.bincount(places, x, len(keys)))})

    kind = rows.schema["k"].dataType.simpleString()
    found = (
        left.groupBy("part", "block")
        .cogroup(right.groupBy("part", "block"))
        .applyInArrow(meet, f"k {kind}, sums array<double>, n double")
    )
    if blocks > 1:
        found = found.groupBy("k").agg(vx.sums(F.col("sums"), dim).alias("sums"), F.sum("n").alias("n"))
    return found.select(F.col("k").alias(key), "sums", "n")
