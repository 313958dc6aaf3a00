"""Ranked search against every document scored by its definition."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, empty, messy
from pyspark.sql import functions as F

from tomelight.llm import maxsketch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in wanted & bag.keys()
            )
            if score > 0:
                scored.append((-score, doc))
        out += [(item, r + 1, doc, -score) for r, (score, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(docs, items, k, **options):
    rows = maxsketch.ranked(docs, items, k, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in rows.collect())


def corpus(spark, n=400):
    rng = np.random.default_rng(3)
    words = [f"W{i}" if i % 5 else f"wört{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 80), p=None))) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # more ties than places
    items = [(i, " ".join(rng.choice(words, 12)) + " unknown") for i in range(30)]
    return rows, items


@pytest.mark.parametrize("sketch", [7, 64, maxsketch.SKETCH])
def test_all_scores(spark, sketch):
    rows, items = corpus(spark)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert found(docs, spark.createDataFrame(items, ITEMS), 50, sketch=sketch) == brute(rows, items, 50)


def test_blocks_of_queries_and_short_runs(spark, monkeypatch):
    rows, items = corpus(spark, 120)
    for name, value in (("QUERY_BLOCK", 7), ("RUN", 16), ("STEP", 3)):
        monkeypatch.setattr(maxsketch, name, value)
    blocks = list(maxsketch.query_blocks(spark.createDataFrame(items, ITEMS), 7))
    assert [len(b.ids) for b in blocks] == [7, 7, 7, 7, 2]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert found(docs, spark.createDataFrame(items, ITEMS), 5) == brute(rows, items, 5)


def test_bounds_hold_and_most_documents_are_not_scored(spark):
    rows, items = corpus(spark)
    bags = [np.unique(maxsketch.terms_of(t), return_counts=True) for _, t in rows]
    queries = maxsketch.queries_of([(i, np.unique(maxsketch.terms_of(t))) for i, t in items])
    df = np.array([sum(t in set(b[0].tolist()) for b in bags) for t in queries.terms.tolist()])
    lengths = np.array([b[1].sum() for b in bags])
    search = maxsketch.Searcher(queries, df, len(rows), int(lengths.sum()), 10, 512)
    ends = np.concatenate([[0], np.cumsum([len(b[0]) for b in bags])])
    flat, tfs = (np.concatenate([b[i] for b in bags]) for i in (0, 1))
    docs = np.repeat(np.arange(len(bags)), np.diff(ends))
    impact = maxsketch.impacts(tfs, lengths[docs], len(rows), int(lengths.sum()))
    bounds = search.bounds(docs, flat, impact, len(bags))
    every = maxsketch.Searcher(queries, df, len(rows), int(lengths.sum()), len(rows), 512)
    every.meet(np.arange(len(bags)), ends, lengths, flat, tfs)
    scores = np.zeros_like(bounds)
    for q, ranking in enumerate(every.best):
        scores[ranking.ids, q] = ranking.scores
    assert (bounds >= scores).all()
    tenth = np.sort(scores, axis=0)[-10]
    assert (bounds >= tenth).mean() < 0.4


def test_messy_rows(spark):
    docs = messy(spark, [(8, "alpha ONE"), (8, "one one"), (9, "épsilon [one]")])
    items = spark.createDataFrame(
        [(1, "alpha one"), (1, "épsilon"), (2, None), (3, "!!"), (None, "one"), (4, "nowhere"), (5, "One ONE one")], ITEMS
    ).withColumn("doc_id", F.lit("clash"))
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert found(docs, items, 50) == expected and {r[0] for r in expected} == {1, 5}
    assert found(empty(spark), items, 50) == []
    assert found(docs, empty(spark).withColumnRenamed("doc_id", "item_id"), 50) == []
