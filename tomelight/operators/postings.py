"""Lexical search over postings: term-partitioned lists by block, pruned by score bounds.

The index is cut into blocks of at most ``BLOCK`` rows. A posting list holds one term's rows
in one block with their weights and the largest of them; lists lie in files in the order of
their terms, so a batch of queries reads the lists of its terms. A term's statistics are its
largest weight and the ``TOP`` largest.

Queries are answered in three steps, all joins on keys that the lists are partitioned by:

1. A term's k-th largest weight times the query's is a score that k rows reach, so the best of these
   is a score below which no row can rank.
2. Terms are ordered by what they can add at most. Those that together stay below that score
   are not looked up (a row that has only them cannot rank); the others, the rare and heavy ones,
   name the blocks, and a block is kept where its own largest weights can reach the score.
3. A kept block is scored exactly by the lists of all the query's terms in it; the block's best k go on.

Results are those of scoring every row: equal scores at the compared precision go to the
smaller id, and rows without a common term fill up with score 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import materialize
from . import topk
from .joins import lookup, salted_join

BLOCK = 4096
TOP = 100
#: Queries whose scores in one block are computed in one task.
QUERY_GROUP = 4096
SLACK = 2 * 10.0**-topk.DIGITS


@dataclass
class Postings:
    """Posting lists (term, block, top, ids, weights), statistics (term, tops) and row ids."""

    lists: DataFrame
    terms: DataFrame
    ids: DataFrame


def build(rows: DataFrame, id: str = "chunk_id") -> Postings:
    """Write the lists of all rows (id, terms, weights); weights must not be below 0.

    Rows are inverted block by block where they lie; the lists are shuffled once.
    """
    rows = topk.side(rows, id, None, "terms", "weights")
    kind = rows.schema["id"].dataType.simpleString()

    def inverted(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in topk.sliced(batch, BLOCK):
                row = np.repeat(np.arange(len(block)), block.lengths)
                order = np.argsort(block.terms, kind="stable")
                order = order[block.weights[order] > 0]
                term, weight = block.terms[order], block.weights[order]
                starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else order
                ends = pa.array(np.append(starts, len(term)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(term[starts], pa.int32()),
                        pa.array(np.full(len(starts), number), pa.int64()),
                        pa.array(np.maximum.reduceat(weight, starts) if len(term) else weight),
                        pa.ListArray.from_arrays(ends, block.ids.take(pa.array(row[order]))),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    ["term", "block", "top", "ids", "weights"],
                )
                number += 1

    schema = f"term int, block long, top double, ids array<{kind}>, weights array<double>"
    lists = rows.mapInArrow(inverted, schema).repartitionByRange("term", "block").sortWithinPartitions("term", "block")
    lists = materialize(lists)

    def largest(batches):
        """The largest weights of each term among the lists of a task."""
        for batch in batches:
            weights = batch.column("weights")
            sizes = pc.list_value_length(weights).to_numpy()
            flat = weights.flatten().to_numpy()
            term = np.repeat(batch.column("term").to_numpy(), sizes)
            order = np.lexsort((-flat, term))
            term, flat = term[order], flat[order]
            first = np.searchsorted(term, term)
            keep = np.arange(len(term)) - first < TOP
            yield pa.RecordBatch.from_arrays([pa.array(term[keep]), pa.array(flat[keep])], ["term", "w"])

    # A term lies in as many tasks as its lists fill and keeps TOP weights of each.
    best = Window.partitionBy("term").orderBy(F.desc("w"))
    tops = lists.select("term", "weights").mapInArrow(largest, "term int, w double")
    tops = tops.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= TOP)
    tops = tops.groupBy("term").agg(F.reverse(F.sort_array(F.collect_list("w"))).alias("tops"))
    return Postings(lists, materialize(tops), materialize(rows.select("id")))


def asked_terms(queries: DataFrame, id: str = "query_id") -> DataFrame:
    """query_id, term and qw of all non-zero query weights."""
    pairs = F.arrays_zip(F.col("terms").alias("term"), F.col("weights").alias("qw"))
    rows = queries.select(F.col(id).alias("query_id"), F.inline(pairs))
    return rows.select("query_id", F.col("term").cast("int").alias("term"), F.col("qw").cast("double").alias("qw")).filter("qw > 0")


def essential(asked: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The query terms to look up: query_id, term, qw, floor (a score that k rows reach) and
    rest (what the terms left out can add).

    ``terms`` joins in parts where many queries ask for one term.
    """
    if k > TOP:
        raise ValueError(f"k must be at most {TOP}")
    found = salted_join(asked, terms.select("term", "tops"), "term", "query_id", how="inner")
    kth = F.coalesce(F.get("tops", F.lit(k - 1)), F.lit(0.0))
    # A group is one query's terms.
    mine = Window.partitionBy("query_id")
    adds = found.select(
        "query_id", "term", "qw", (F.col("qw") * F.get("tops", F.lit(0))).alias("adds"), (F.col("qw") * kth).alias("reached")
    )
    placed = adds.withColumn("floor", F.max("reached").over(mine)).withColumn(
        "upto", F.sum("adds").over(mine.orderBy("adds", "term").rowsBetween(Window.unboundedPreceding, 0))
    )
    looked_up = F.col("upto") >= F.col("floor") - SLACK
    rest = F.coalesce(F.max(F.when(~looked_up, F.col("upto"))).over(mine), F.lit(0.0))
    return placed.withColumn("rest", rest).filter(looked_up).select("query_id", "term", "qw", "floor", "rest")


def promising(needed: DataFrame, lists: DataFrame) -> DataFrame:
    """query_id and block of the blocks whose largest weights can reach the query's floor."""
    joined = needed.join(lists.select("term", "block", "top"), "term")
    bound = F.sum(F.col("qw") * F.col("top")) + F.first("rest")
    sums = joined.groupBy("query_id", "block").agg(bound.alias("bound"), F.first("floor").alias("floor"))
    return sums.filter(F.col("bound") >= F.col("floor") - SLACK).select("query_id", "block")


def search(
    queries: DataFrame, postings: Postings, k: int, id: str = "query_id", skip_self: bool = False
) -> DataFrame:
    """The best k rows per query by inner product: query_id, rank, item_id, score.

    With ``skip_self`` a query is a row of the index, which it never finds.
    """
    if skip_self:
        others = search(queries, postings, k + 1, id).filter("query_id <> item_id")
        return topk.cut(others, F.col("score"), k, F.col("item_id"))
    asked = materialize(asked_terms(queries, id))
    needed = materialize(essential(asked, postings.terms, k))
    blocks = materialize(promising(needed, postings.lists))
    parts = max(1, math.ceil(queries.count() / QUERY_GROUP))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part")
    wanted = materialize(blocks.join(asked, "query_id").select("block", part, "query_id", "term", "qw"))
    held = lookup(postings.lists, wanted.select("term", "block", "part").distinct(), ["term", "block"])
    # Fresh aliases keep apart what comes from the same requests.
    held = held.select(*(F.col(c).alias(c) for c in ("block", "part", "term", "ids", "weights")))
    kinds = queries.schema[id].dataType.simpleString(), postings.ids.schema["id"].dataType.simpleString()
    empty = pa.schema(
        [("query_id", topk.arrow_id(queries, id)), ("item_id", topk.arrow_id(postings.ids, "id")), ("score", pa.float64())]
    ).empty_table()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.column("ids").combine_chunks().flatten().dictionary_encode()
        ids, places = rows.dictionary, rows.indices.to_numpy()
        weights = right.column("weights").combine_chunks().flatten().to_numpy()
        sizes = pc.list_value_length(right.column("ids")).to_numpy()
        ends = np.cumsum(sizes)
        where = {t: (e - n, e) for t, e, n in zip(right.column("term").to_pylist(), ends.tolist(), sizes.tolist(), strict=True)}
        order = np.empty(len(ids), np.int64)
        order[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
        table = left.take(pc.sort_indices(left, sort_keys=[("query_id", "ascending"), ("term", "ascending")])).combine_chunks()
        names = table.column("query_id").combine_chunks().dictionary_encode()
        cuts = np.flatnonzero(np.diff(names.indices.to_numpy())) + 1
        term, qw = (table.column(c).to_numpy() for c in ("term", "qw"))
        out = []
        for query, lines in enumerate(np.split(np.arange(len(term)), cuts)):
            total = np.zeros(len(ids))
            for i in lines:
                a, b = where.get(int(term[i]), (0, 0))
                total[places[a:b]] += qw[i] * weights[a:b]
            hit = np.flatnonzero(total > 0)
            best = hit[np.lexsort((order[hit], -topk.fixed_point(total[hit])))[:k]]
            out.append((np.full(len(best), query), best, total[best]))
        if not out:
            return empty
        query, row, total = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table(
            {"query_id": names.dictionary.take(pa.array(query)), "item_id": ids.take(pa.array(row)), "score": pa.array(total)}
        )

    found = (
        wanted.groupBy("block", "part")
        .cogroup(held.groupBy("block", "part"))
        .applyInArrow(score, f"query_id {kinds[0]}, item_id {kinds[1]}, score double")
    )
    best = topk.cut(found, F.col("score"), k, F.col("item_id"))
    return filled(materialize(best), queries.select(F.col(id).alias("query_id")), postings, k)


def filled(best: DataFrame, queries: DataFrame, postings: Postings, k: int) -> DataFrame:
    """Queries with fewer than k rows get the rows of the smallest ids, with score 0."""
    found = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = queries.join(found, "query_id", "left").filter(F.coalesce("n", F.lit(0)) < k).select("query_id")
    columns = ["query_id", "item_id", "score"]
    smallest = [r["id"] for r in postings.ids.orderBy("id").limit(2 * k).collect()]
    if not smallest:
        return best.select("query_id", "rank", "item_id", "score")
    fill = short.select("query_id", F.explode(F.array(*map(F.lit, smallest))).alias("item_id"))
    fill = fill.join(best.select("query_id", "item_id"), ["query_id", "item_id"], "left_anti")
    rows = best.select(columns).union(fill.withColumn("score", F.lit(0.0)).select(columns))
    return topk.cut(rows, F.col("score"), k, F.col("item_id")).select("query_id", "rank", "item_id", "score")
