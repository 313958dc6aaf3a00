from collections import Counter

import numpy as np
from helpers import DOCS, empty, messy
from hypothesis import given, settings
from hypothesis import strategies as st

from tomelight.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(-1, 4), max_size=20))
def test_subsequence_against_brute_force(a, b):
    best, begin, end = dc.subsequence(np.array(a, int), np.array(b, int))
    assert best == lcs(a, b) and lcs(a, b[begin:end]) == best and end - begin <= len(b)


def corpus(seed=1):
    """Documents of frequent and rare words; some with items, whole, changed, or in part."""
    rng = np.random.default_rng(seed)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i}" for i in range(5000)]

    def text(n):
        return [str(rng.choice(common)) if rng.random() < 0.5 else str(rng.choice(rare)) for _ in range(n)]

    items = {i: text(int(rng.integers(8, 140))) for i in range(30)}
    docs, expected = {}, set()
    for d in range(300):
        words = text(int(rng.integers(0, 400)))
        kind, item = d % 6, int(rng.integers(0, 30))
        put = list(items[item])
        if kind == 1:  # a paraphrase: some words replaced, some dropped
            for _ in range(len(put) // 10):
                put[int(rng.integers(0, len(put) - 2))] = str(rng.choice(rare))
        elif kind == 2:  # the words of the item in any order: no contamination
            rng.shuffle(put)
        elif kind > 2:
            put = []
        at = int(rng.integers(0, len(words) + 1))
        docs[d] = [*words[:at], *put, *words[at:]]
        if kind < 2:
            expected.add((d, item))
    return docs, items, expected


def test_against_planted_and_brute_force(spark):
    docs, items, expected = corpus()
    frame = spark.createDataFrame([(d, " ".join(w).title()) for d, w in docs.items()], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, ", ".join(w)) for i, w in items.items()], ITEMS)
    found = {(r.doc_id, r.item_id): r for r in dc.contaminated(frame, bench).collect()}
    assert set(found) == expected
    for (d, i), r in found.items():
        n, size = -(-len(items[i]) // dc.PART), len(items[i])
        parts = [items[i][k * size // n : (k + 1) * size // n] for k in range(n)]
        best = max(lcs(part, docs[d]) / len(part) for part in parts)
        assert r.matched <= r.query_words and r.matched / r.query_words <= best + 1e-9
        assert docs[d][r.first_word] in items[i]
    kept = dc.keep_clean(frame, bench)
    assert {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in expected} and kept.columns == frame.columns


@settings(deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.lists(st.integers(-1, 4), min_size=9, max_size=9), min_size=1, max_size=4))
def test_longest_common_against_brute_force(a, rows):
    assert dc.longest_common(np.array(a, int), np.array(rows, int)).tolist() == [lcs(a, b) for b in rows]


def pairs_by_brute_force(docs, items):
    """Every stretch of every document against every part."""
    codes = {}
    found = set()
    for i, item in items.items():
        n, size = -(-len(item) // dc.PART), len(item)
        for k in range(n):
            part = np.array([codes.setdefault(w, len(codes)) for w in item[k * size // n : (k + 1) * size // n]])
            longest = int(dc.STRETCH * len(part))
            for d, words in docs.items():
                text = np.array([codes.setdefault(w, len(codes)) for w in words] + [-1] * longest)
                stretches = np.lib.stride_tricks.sliding_window_view(text, longest)
                if (dc.longest_common(part, stretches) >= dc.COVERED * len(part) - 1e-9).any():
                    found.add((d, i))
    return found


def test_rarest_words_replaced(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"v{i}" for i in range(3000)]

    def text(n):
        return [vocabulary[min(int(x), 2999)] for x in rng.zipf(1.25, n)]

    items = {i: [f"name{i}", f"number{i}", *text(int(rng.integers(14, 70))), f"place{i}"] for i in range(10)}
    count = Counter(w for item in items.values() for w in item)
    count.update(text(20_000))
    docs = {}
    for d in range(60):
        words, put = text(int(rng.integers(20, 120))), list(items[d % 10])
        rarest = sorted(range(len(put)), key=lambda k: (count[put[k]], k))
        for k in rarest[: d // 10]:
            put[k] = f"new{d}x{k}"
        at = int(rng.integers(0, len(words) + 1))
        docs[d] = [*words[:at], *put, *words[at:]]
    docs |= {60 + d: text(200) for d in range(20)}
    expected = pairs_by_brute_force(docs, items)
    assert sum(d // 10 >= 3 for d, i in expected if d < 60 and i == d % 10) > 20
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], ITEMS)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(frame, bench).collect()} == expected


def test_sketch_is_the_product_over_all_windows(spark):
    rng = np.random.default_rng(4)
    docs = [(d, " ".join(f"t{rng.integers(0, 30)}" for _ in range(int(rng.integers(0, 200))))) for d in range(40)]
    terms = {f"t{i}": i for i in range(25)}
    coded = dc.encode(spark.createDataFrame(docs, DOCS).repartition(3), terms)
    weight = rng.random(25).astype(np.float32)
    rows = []
    for _, text in docs:
        ids = [terms.get(w, -1) for w in text.split()]
        for start in range(0, len(ids), dc.BLOCK):
            row = np.zeros(25)
            for t in ids[start : start + 2 * dc.BLOCK]:
                if t >= 0:
                    row[t] += weight[t]
            rows.append(row)
    a = np.array(rows)
    x = np.random.default_rng(7).standard_normal((25, 6)).astype(np.float32)
    assert np.allclose(dc.sketch(coded, weight, 6), a.T @ (a @ x), rtol=1e-3, atol=1e-2)
    counts, total = dc.frequencies(coded, 25)
    words = [w for _, t in docs for w in t.split()]
    assert total == len(words) and [int(c) for c in counts] == [words.count(f"t{i}") for i in range(25)]


def test_answers_must_be_told(spark):
    body = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{body} forty two apples"), (2, f"{body} nothing of that")], DOCS)
    bench = spark.createDataFrame([(5, body, "forty two apples")], "item_id long, text string, answer string")
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()] == [(1, 5)]


def test_cut_passages_are_found(spark):
    items = {i: [f"i{i}w{k}" for k in range(20 + 4 * i)] for i in range(8)}
    docs = {}
    for i, item in items.items():
        cut = int(0.15 * len(item))
        docs |= {10 * i: item[cut:], 10 * i + 1: item[:-cut], 10 * i + 2: item[cut:-cut], 10 * i + 3: item[: len(item) // 2]}
    frame = spark.createDataFrame([(d, " ".join(["before", *w, "after"])) for d, w in docs.items()], DOCS)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], ITEMS)
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(frame, bench).collect()}
    assert found == {(10 * i + k, i) for i in items for k in range(3)}


def test_answer_over_two_parts(spark):
    asked, answer = [f"q{i}" for i in range(30)], [f"a{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(asked)), (2, " ".join(answer[18:]))], DOCS)
    bench = spark.createDataFrame([(5, " ".join(asked), " ".join(answer))], "item_id long, text string, answer string")
    queries = dc.read_queries(bench)
    assert [len(p) for p in queries.parts] == [45, 45] and queries.answers == [15, 45]
    assert [r.doc_id for r in dc.contaminated(docs, bench).collect()] == [2]


def test_messy_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, "a plain line of words second line"), (4, "a plain line of words second line"), (4, "a plain line of words second line")], ITEMS)
    df = messy(spark)
    assert sorted((r.doc_id, r.item_id) for r in dc.contaminated(df, bench).collect()) == [(7, 4)]
    kept = dc.keep_clean(df, bench)
    assert kept.columns == df.columns and kept.count() == 7
    shared = spark.createDataFrame(
        [(None, "A plain line of words, second line!"), (None, "clean"), (1, "a plain line of words second line"), (1, "clean too"), (1, None)], DOCS
    )
    left = {(r.doc_id, r.text) for r in dc.keep_clean(shared, bench).collect()}
    assert left == {(None, "clean"), (1, "clean too"), (1, None)}
    assert dc.contaminated(df, spark.createDataFrame([], ITEMS)).collect() == []
    assert dc.contaminated(empty(spark), bench).collect() == []


def test_routes(spark):
    """The lexical route alone finds all; the latent one most of the passages that are whole."""
    docs, items, expected = corpus(5)
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], ITEMS)
    found = {
        route: {(r.doc_id, r.item_id) for r in dc.contaminated(frame, bench, routes=(route,)).collect()}
        for route in ("latent", "lexical")
    }
    assert found["lexical"] == expected and found["latent"] <= expected
    assert len(found["latent"]) >= 0.8 * len(expected)


def test_queries_in_blocks(spark, monkeypatch):
    docs, items, expected = corpus(6)
    for name, value in (("QUERY_PARTS", 11), ("PART_RUN", 4)):
        monkeypatch.setattr(dc, name, value)
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], DOCS).repartition(2)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], ITEMS)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(frame, bench).collect()} == expected


def test_sums_of_columns():
    rng = np.random.default_rng(5)
    table, owner = rng.standard_normal((3, 40)).astype(np.float32), np.sort(rng.integers(0, 12, 200))
    columns = rng.integers(0, 40, 200).astype(np.int32)
    expected = np.zeros((3, 15), np.float32)
    np.add.at(expected.T, owner, table.T[columns])
    assert np.allclose(dc.summed(table, columns, owner, 15), expected, atol=1e-5)
    assert not dc.summed(table, columns[:0], owner[:0], 15).any()


def test_words_looked_up_in_two_steps():
    rng = np.random.default_rng(6)
    parts = [rng.integers(0, 60, n).astype(np.int32) for n in (5, 16, 17, 30, 48, 48)]
    counts, space = rng.integers(1, 99, 60), rng.standard_normal((60, 4)).astype(np.float32)
    latent = np.array([space[part].sum(axis=0) for part in parts])
    found = dc.Candidates(parts, counts, space, latent, -2.0, 3)  # every window with a known word
    of = np.repeat([0, 1, 2], [9, 1, 6])
    block = np.sort(rng.integers(0, len(of), 400))
    terms = rng.integers(0, 60, 400).astype(np.int32)
    held = [{int(t) for t, b in zip(terms, block, strict=True) if w <= b < w + 3 and of[b] == of[w]} for w in range(len(of))]
    expected = {(w, q) for w in range(len(of)) for q, part in enumerate(parts) if sum(int(t) in held[w] for t in part) >= dc.needed(part)}
    assert 0 < len(expected) < len(of) * len(parts)
    assert set(zip(*(x.tolist() for x in found.pairs(terms, block, of)), strict=True)) == expected
    assert dc.words("a_b Ünder_Über__ _") == ["a", "b", "ünder", "über"]
