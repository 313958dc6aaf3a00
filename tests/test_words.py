from pathlib import Path

import numpy as np
import pytest

from tomelight.operators import blocks, skipgram, words
from tomelight.sources import files, store


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<float>")


def test_windows(spark):
    df = spark.createDataFrame(
        [(22, [f"w{i}" for i in range(22)]), (23, [f"w{i}" for i in range(23)]), (0, [])],
        "doc_id long, lemmas array<string>",
    )
    rows = words.windows(df).collect()
    sizes = {n: [len(r.sentence) for r in rows if r.doc_id == n] for n in (22, 23, 0)}
    assert sizes == {22: [10, 10], 23: [10, 10, 3], 0: []}


def test_doc_means(spark, vectors):
    df = spark.createDataFrame(
        [(1, ["a", "b", "zzz"]), (2, ["zzz"]), (3, []), (4, ["a", "a", "b"])],
        "doc_id long, lemmas array<string>",
    )
    skip = {r.doc_id: r.embedding for r in words.doc_means(df, vectors).collect()}
    zero = {r.doc_id: r.embedding for r in words.doc_means(df, vectors, oov="zero").collect()}
    assert skip[1] == [1.0, 1.0] and skip[2] == [0.0, 0.0] and skip[3] == [0.0, 0.0]
    assert zero[1] == pytest.approx([2 / 3, 2 / 3]) and zero[2] == [0.0, 0.0]
    assert skip[4] == pytest.approx([4 / 3, 2 / 3])
    with pytest.raises(ValueError):
        words.doc_means(df, vectors, oov="other")


def test_oov_report(spark, vectors):
    df = spark.createDataFrame([(["a", "c", "d", "a"],)], "lemmas array<string>")
    row = words.oov_report(df, vectors, "m").first()
    assert (row.total_words, row.in_vocab, row.oov_count, row.oov_words) == (3, 1, 2, ["c", "d"])
    assert row.oov_percentage == pytest.approx(200 / 3)
    assert words.oov_report(df, vectors, "ft", subword=True).first().oov_count == 0
    empty = words.oov_report(df.limit(0), vectors, "m").first()
    assert empty.total_words == 0 and empty.oov_percentage is None
    both = words.compare_oov(df, {"one": vectors, "two": vectors.limit(0), "three": None}).collect()
    assert {r.model: r.oov_count for r in both} == {"one": 2, "two": 3}
    with pytest.raises(ValueError):
        words.compare_oov(df, {})


def test_pair_similarity(spark, vectors):
    pairs = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "zz")], "word1 string, word2 string")
    got = {(r.word1, r.word2): r.similarity for r in words.pair_similarity(pairs, vectors).collect()}
    assert got == {("a", "b"): 0.0, ("a", "a"): 1.0, ("a", "zz"): None}


def test_nearest_words_unknown(spark, vectors):
    asked = spark.createDataFrame([("a",), ("zz",)], "word string")
    got = words.nearest_words(vectors, 10, asked).collect()
    assert [(r.query_id, r.item_id) for r in got] == [("a", "b")]


def test_subwords_match_brute_force(spark):
    rng = np.random.default_rng(0)
    known = {w: rng.normal(size=3) for w in ["pump", "pumps", "jump", "valve", "ab"]}
    df = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in known.items()], "word string, vector array<double>")

    def grams(w):
        m = f"<{w}>"
        return {m[i : i + n] for n in range(3, 7) for i in range(len(m) - n + 1)}

    table = {}
    for g in set().union(*map(grams, known)):
        table[g] = np.mean([v for w, v in known.items() if g in grams(w)], axis=0)
    wanted = spark.createDataFrame([("pumped",), ("valve",), ("qqq",)], "word string")
    got = {r.word: r for r in words.with_subwords(wanted, df, words.subword_vectors(df)).collect()}
    expected = np.mean([table[g] for g in grams("pumped") if g in table], axis=0)
    assert got["pumped"].vector == pytest.approx(list(expected)) and not got["pumped"].trained
    assert got["valve"].vector == pytest.approx(list(known["valve"])) and got["valve"].trained
    assert got["qqq"].vector == [0.0, 0.0, 0.0]


def test_select_words(spark, vectors):
    freq = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "term string, freq long")
    assert [r.word for r in words.select_words(vectors, freq, 1).collect()] == ["b"]
    assert [r.word for r in words.select_words(vectors, chosen=["a", "zz"]).collect()] == ["a"]


def test_subwords_of_unseen_words_alone(spark):
    """Without a gram table only the n-grams that unseen words need are made."""
    rng = np.random.default_rng(0)
    known = {w: rng.normal(size=3) for w in ["pump", "pumps", "jump", "valve", "ab"]}
    df = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in known.items()], "word string, vector array<double>")
    wanted = spark.createDataFrame([("pumped",), ("valve",), ("qqq",), ("jumps",)], "word string")
    whole = {r.word: tuple(r.vector) for r in words.with_subwords(wanted, df, words.subword_vectors(df)).collect()}
    assert {r.word: pytest.approx(r.vector) for r in words.with_subwords(wanted, df).collect()} == whole


@pytest.mark.parametrize("limits", [{}, {"block_values": 6, "part_edges": 5}])
def test_weighted_sums(spark, limits):
    rng = np.random.default_rng(5)
    vectors = {f"w{i}": rng.normal(size=3) for i in range(9)}
    edges = [(int(k), f"w{int(w)}", float(x)) for k, w, x in zip(rng.integers(0, 7, 60), rng.integers(0, 12, 60), rng.random(60))]
    edges += [(None, "w1", 1.0), (3, None, 1.0), (99, "unknown", 1.0)]
    table = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in vectors.items()], "word string, vector array<double>")
    rows = spark.createDataFrame(edges, "id long, word string, weight double")
    sums, n = {}, {}
    for k, w, x in edges:
        if k is not None and w in vectors:
            sums[k] = sums.get(k, 0) + x * vectors[w]
            n[k] = n.get(k, 0) + x
    got = {r.id: r for r in blocks.weighted_sums(rows, table, 3, "id", **limits).collect()}
    assert set(got) == set(sums)
    assert all(got[k].sums == pytest.approx(list(sums[k])) and got[k].n == pytest.approx(n[k]) for k in got)
    assert blocks.weighted_sums(rows.limit(0), table, 3, "id").collect() == []
    assert blocks.weighted_sums(rows, table.limit(0), 3, "id").collect() == []


def test_no_vector_per_document_and_word_is_shuffled(spark, vectors):
    df = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, lemmas array<string>")
    text = words.doc_means(df, vectors, dim=2)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in text.splitlines() if "Exchange" in line]
    assert "FlatMapCoGroupsInArrow" in text and exchanged and "vector" not in " ".join(exchanged)


def topics(seed=0, n=400):
    """Sentences of two topics; words of one topic occur together."""
    rng = np.random.default_rng(seed)
    names = [[f"{t}{i}" for i in range(12)] for t in "xy"]
    return [([str(w) for w in rng.choice(names[i % 2], 8)],) for i in range(n)] + [(["rare", "x1", "x2"],)]


def cosine_of(vectors, a, b):
    x, y = vectors[a], vectors[b]
    return float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))


def apart(vectors):
    """Share of words whose nearest word is of their own topic."""
    names = [w for w in vectors if w[0] in "xy" and w[1:].isdigit()]
    near = [max((o for o in names if o != w), key=lambda o: cosine_of(vectors, w, o)) for w in names]
    return np.mean([a[0] == b[0] for a, b in zip(names, near)])


@pytest.mark.parametrize("parts", [1, 3])
def test_skipgram_brings_words_of_a_topic_together(spark, parts):
    df = spark.createDataFrame(topics(), "sentence array<string>")
    options = dict(vector_size=16, sample=None, parts=parts, epochs=12, rate=0.05)
    table, grams = skipgram.train(df, **options)
    rows = table.collect()
    vectors = {r.word: np.array(r.vector) for r in rows}
    counts = {r.word: r.n for r in rows}
    assert grams is None and "rare" not in vectors and len(vectors) == 24
    assert all(len(v) == 16 and np.isfinite(v).all() for v in vectors.values())
    assert counts["x1"] == sum(s.count("x1") for (s,) in topics())
    assert apart(vectors) == 1.0


def test_skipgram_with_subwords_places_unseen_words(spark):
    rng = np.random.default_rng(2)
    stems = [[f"{t}{c}" for c in ("ing", "ed", "er", "ers", "able", "ly", "ful")] for t in ("pump", "glow")]
    sentences = [([str(w) for w in rng.choice(stems[i % 2], 8)],) for i in range(300)]
    df = spark.createDataFrame(sentences, "sentence array<string>")
    table, grams = skipgram.train(df, vector_size=12, sample=None, parts=2, epochs=8, buckets=500, rate=0.05)
    table, grams = store.materialize(table), store.materialize(grams)
    assert grams.filter("bucket < 0 OR bucket >= 500").isEmpty()
    wanted = spark.createDataFrame([("pumps",), ("glowy",), ("pumping",), ("zz",)], "word string")
    found = {r.word: r for r in skipgram.vectors_of(wanted, table, grams, 500, 12).collect()}
    assert {w for w, r in found.items() if r.trained} == {"pumping"}
    vectors = {w: np.array(r.vector) for w, r in found.items()}
    assert cosine_of(vectors, "pumps", "pumping") > cosine_of(vectors, "glowy", "pumping") + 0.2
    assert len(found["zz"].vector) == 12


def test_skipgram_of_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "sentence array<string>")
    assert skipgram.train(df, vector_size=3, epochs=1)[0].collect() == []
    with pytest.raises(ValueError):
        skipgram.train(df, epochs=0)


def test_averages_are_weighted_by_occurrences(spark, monkeypatch):
    monkeypatch.setattr(skipgram, "MERGE", 2)
    rng = np.random.default_rng(4)
    rows = [(p, u, float(rng.integers(1, 9)), [float(x) for x in rng.normal(size=4)]) for p in range(7) for u in range(-3, 40)]
    df = spark.createDataFrame(rows, "part int, unit long, times double, v array<float>").repartition(5)
    for parts in (1, 7):
        got = {r.unit: r.v for r in skipgram.averaged(df, parts).collect()}
        for unit in range(-3, 40):
            own = [(t, np.array(v)) for _, u, t, v in rows if u == unit]
            mean = sum(t * v for t, v in own) / sum(t for t, _ in own)
            assert got[unit] == pytest.approx(list(mean), abs=1e-5)
        assert len(got) == 43


def test_steps_follow_the_gradient():
    """One step on one pair moves the score up, one on a drawn word down; shared rows add up."""
    settings = skipgram.Settings(4, 2, 5, 0.1, None, 1, 1)
    rng = np.random.default_rng(0)
    part = skipgram.Part(rng.normal(size=(3, 4)).astype("f"), rng.normal(size=(3, 4)).astype("f"), np.ones(3), 3, None, settings)
    before = part.inputs @ part.outputs.T
    part.step(np.array([0, 0]), np.array([1, 1]), np.array([2]), np.float32(0.05))
    after = part.inputs @ part.outputs.T
    assert after[0, 1] > before[0, 1] and after[0, 2] < before[0, 2]
    matrix = np.zeros((3, 2), np.float32)
    skipgram.add_rows(matrix, np.array([2, 0, 2]), np.ones((3, 2), np.float32))
    assert matrix.tolist() == [[1, 1], [0, 0], [2, 2]]


def test_pca_is_centred(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(40, 3)) * [5, 2, 0.1] + 100
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, vector array<double>")
    placed, explained = words.pca(df)
    coords = np.array([r.coords for r in placed.orderBy("id").collect()])
    centred = data - data.mean(0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(coords) == pytest.approx(np.abs(u[:, :2] * s[:2]), abs=1e-6)
    assert explained == pytest.approx(list((s**2 / (s**2).sum())[:2]))


def test_read_word_vectors(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("pump 1.0 2.0\nbad 1.0\nworse x 2.0\nvalve 0 -1\n")
    got = {r.word: list(r.vector) for r in files.read_word_vectors(spark, str(path), 2).collect()}
    assert got == {"pump": [1.0, 2.0], "valve": [0.0, -1.0]}


def test_runs_of_centres_train_on_every_pair():
    """A run's step is that of its pairs, and the marked pairs are those within the drawn reaches."""
    rng = np.random.default_rng(3)
    tokens, sentence = rng.integers(0, 9, 60), np.repeat([4, 7, 8, 20], [1, 30, 9, 20])
    moved, place, size = skipgram.shuffled(tokens, sentence, rng)
    starts = np.flatnonzero(place == 0)
    assert sorted(map(tuple, np.split(moved, starts[1:]))) == sorted(tuple(tokens[sentence == s]) for s in set(sentence))
    before, behind = skipgram.reaches(place, size, 5, rng)
    assert (before <= place).all() and (behind < size - place).all() and before.max() == behind.max() == 5
    at = np.arange(60)
    paired = (at >= (at - before)[:, None]) & (at <= (at + behind)[:, None]) & (at != at[:, None])
    assert paired.sum() == (before + behind).sum() > 100

    settings = skipgram.Settings(4, 5, 5, 0.1, None, 1, 1)
    inputs, outputs, drawn = rng.normal(size=(9, 4)).astype("f"), rng.normal(size=(9, 4)).astype("f"), np.array([2, 2, 5])
    whole, single = (skipgram.Part(inputs.copy(), outputs.copy(), np.ones(9), 9, None, settings) for _ in range(2))
    whole.step(moved, moved, drawn, 0.05, paired)
    i, j = np.nonzero(paired)
    single.step(moved[i], moved[j], drawn, 0.05)
    assert np.allclose(whole.inputs, single.inputs, atol=1e-4) and np.allclose(whole.outputs, single.outputs, atol=1e-4)
    assert not np.allclose(whole.inputs, inputs, atol=1e-2)


def test_parts_get_the_vectors_that_their_edges_name(spark):
    """Many parts and few edges a word: no vector goes to every part, and the sums are the same."""
    rng = np.random.default_rng(8)
    vectors = {f"w{i}": rng.normal(size=3) for i in range(50)}
    edges = [(int(k), f"w{int(w)}", float(x)) for k, w, x in zip(rng.integers(0, 40, 120), rng.integers(0, 60, 120), rng.integers(1, 4, 120), strict=True)]
    table = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in vectors.items()], "word string, vector array<double>")
    rows = spark.createDataFrame([*edges, (None, "w1", 1.0), (3, None, 1.0)], "id long, word string, weight double")
    found = blocks.weighted_sums(rows, table, 3, "id", part_edges=6)
    assert "explode(" not in found._jdf.queryExecution().analyzed().toString()
    got = {r.id: r for r in found.collect()}
    for key in {k for k, _, _ in edges}:
        own = [(vectors[w], x) for k, w, x in edges if k == key and w in vectors]
        if own:
            assert got[key].n == sum(x for _, x in own)
            assert got[key].sums == pytest.approx(list(sum(v * x for v, x in own)))
        else:
            assert key not in got


def test_training_keeps_the_last_tables_only(spark):
    """Of the tables of a training, the words and the last round's vectors are all that is left."""
    rows = spark.createDataFrame([(["river", "stone", "lamp"],), (["stone", "lamp", "cloud"],)] * 4, "sentence array<string>")
    with store.collecting() as made:
        found, _ = skipgram.train(rows, vector_size=4, epochs=6, epochs_per_round=2)
    left = [p for p in made if Path(p.removeprefix("file:")).exists()]
    assert len(made) == 7 and len(left) == 2
    assert {r.word: len(r.vector) for r in found.collect()} == {"river": 4, "stone": 4, "lamp": 4, "cloud": 4}


def test_blocks_follow_the_vectors_of_a_part(spark):
    """A key leaves one sum where its part names few words, however many vectors there are."""
    rng = np.random.default_rng(3)
    table = [(f"w{i}", [float(x) for x in rng.integers(0, 9, 3)]) for i in range(400)]
    edges = [(k, f"w{(k % 2) * 7 + j}", float(j)) for k in range(30) for j in range(4)]
    known = spark.createDataFrame(table, "word string, vector array<float>")
    rows = spark.createDataFrame(edges, "id long, word string, weight double")
    found = blocks.weighted_sums(rows, known, 3, "id", block_values=90, part_edges=60)
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    vectors = dict(table)
    got = {r.id: (r.sums, r.n) for r in found.collect()}
    assert got == {k: ([sum(j * vectors[f"w{(k % 2) * 7 + j}"][i] for j in range(4)) for i in range(3)], 6.0) for k in range(30)}
