import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, empty, messy

from tomelight.llm import dartminhash as dm

WORD = re.compile(r"[^\W_]+")


def shingles(text):
    words = WORD.findall(text.lower())
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter([("=", text)])


def brute(rows, similarity=0.8):
    """Classes by comparing all pairs that share a shingle."""
    bags, holders = {id: shingles(t or "") for id, t in rows}, defaultdict(set)
    for id, bag in bags.items():
        for s in bag:
            holders[s].add(id)
    parent = {id: id for id in bags}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in {p for ids in holders.values() for p in itertools.combinations(sorted(ids), 2)}:
        shared = sum((bags[a] & bags[b]).values())
        if shared >= similarity * (sum(bags[a].values()) + sum(bags[b].values()) - shared) - 1e-9:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {id: root(id) for id in bags}


def corpus(n=400, seed=5):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, id = [], 0
    for group in range(n // 10):
        base = list(rng.choice(vocabulary, int(rng.integers(6, 220))))
        if group % 4 == 0:  # a line said again and again: weights above 1
            base += ["over", "and", "over", "we", "go"] * int(rng.integers(1, 30))
        for _ in range(10):
            words = list(base)
            for _ in range(int(rng.integers(0, 6))):
                words[int(rng.integers(0, len(words)))] = str(rng.choice(vocabulary))
            rows.append((id, " ".join(words)))
            id += 1
    order = rng.permutation(len(rows))
    return [(int(order[i]), t) for i, (_, t) in enumerate(rows)]


def test_classes_against_all_pairs(spark):
    rows = corpus()
    out = dm.classes(spark.createDataFrame(rows, DOCS).repartition(6)).collect()
    expected = brute(rows)
    assert {r.doc_id: r.class_id for r in out} == expected and len(out) == len(rows)
    assert len(set(expected.values())) < 300


def test_links_through_other_than_the_smallest_are_not_lost(spark):
    # Each text is like the next one only, and all share many buckets with the first.
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(12)]
    out = dm.classes(spark.createDataFrame(rows, DOCS), bands=200, rows=1).collect()
    assert {r.doc_id: r.class_id for r in out} == brute(rows)


def test_exact_join_finds_every_pair(spark):
    rows = corpus(200, seed=9)
    df = spark.createDataFrame(rows, DOCS)
    sets = dm.materialize(dm.shingle_sets(df))
    apart = df.selectExpr("doc_id", "doc_id AS label")
    found = dm.verified(dm.across(apart, sets, 0.8), sets, 0.8)
    bags = {id: shingles(t) for id, t in rows}
    expected = set()
    for a, b in itertools.combinations(sorted(bags), 2):
        shared = sum((bags[a] & bags[b]).values())
        if shared >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - shared) - 1e-9:
            expected.add((a, b))
    assert len(expected) > 100 and {(r.a, r.b) for r in found.collect()} == expected
    assert dm.across(apart.selectExpr("doc_id", "1L AS label"), sets, 0.8).isEmpty()


@pytest.mark.parametrize("weighted", [False, True])
def test_agreement_is_the_weighted_similarity(weighted):
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 600).astype(np.uint64)
    full = np.zeros((2, 600))
    for row, part in zip(full, (slice(0, 450), slice(100, 600)), strict=True):
        row[part] = rng.integers(1, 9, 600)[part] if weighted else 1
    k = 4000
    values = [dm.throw(elements[row > 0], row[row > 0], np.zeros(int((row > 0).sum()), int), 1, k)[0] for row in full]
    true = np.minimum(*full).sum() / np.maximum(*full).sum()
    assert abs((values[0] == values[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / k)


def test_throwing_together_changes_nothing():
    rng = np.random.default_rng(2)
    bags = [(rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(1, 5, n)) for n in (1, 2, 40, 900)]
    alone = [dm.buckets_of([b], 24, 4)[0] for b in bags]
    assert all((x == y).all() for x, y in zip(alone, dm.buckets_of(bags, 24, 4), strict=True))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)] + [(1000, 1000 + i) for i in range(1, 30)]
    links = spark.createDataFrame(chain, "a long, b long")
    labels = {r.node: r.label for r in dm.components(links).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100, **{1000 + i: 1000 for i in range(30)}}


def test_messy_rows(spark):
    df = messy(spark, [(20, "ONE"), (21, "one!"), (22, "???")])
    out = dm.classes(df).collect()
    assert len(out) == 12
    by = {r.doc_id: r.class_id for r in out}
    assert by[1] == by[2] == 1 and by[3] == 3 and by[22] == 22
    assert by[4] == by[20] == by[21] == 4 and by[5] == by[6] == 5 and by[7] == 7 and by[None] is None
    kept = dm.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 7, 22, None]))
    assert dm.classes(empty(spark)).collect() == []


def test_rows_of_shingles_are_not_joined_with_their_counts(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(6)]
    sets = dm.shingle_sets(spark.createDataFrame(rows, DOCS))
    placed = spark.range(6).selectExpr("id AS doc_id", "id AS label")
    plans, given = [], dm.materialize

    def recorded(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return given(df)

    monkeypatch.setattr(dm, "materialize", recorded)
    found = {(r.a, r.b) for r in dm.across(placed, sets, 0.5).collect()}
    assert found >= {(i, i + 1) for i in range(5)}
    # The candidates' join by element is made of written rows and comes after these.
    assert plans and not any(re.search(r"Join Inner, .*element", plan) for plan in plans)
