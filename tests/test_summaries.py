import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomelight.operators import overlap, summarize
from tomelight.plans import jobs


def pairs(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pair_id long, pred string, ref string")


def test_rouge(spark):
    df = pairs(spark, ("the cat sat", "the cat ran fast"), ("a a a", "a b"), ("", "x"), ("", ""))
    rows = {r.pair_id: r for r in overlap.rouge_n(df).collect()}
    assert round(rows[0].rouge_1, 6) == 0.571429 and rows[0].rouge_2 == pytest.approx(0.4)
    assert rows[1].rouge_1 == pytest.approx(0.4) and rows[2].rouge_1 == 0.0 and rows[3].rouge_2 == 0.0
    lcs = {r.pair_id: r.rouge_l for r in overlap.rouge_l(df).collect()}
    assert round(lcs[0], 6) == 0.571429 and lcs[2] == 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_lcs_matches_table(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert overlap.lcs_length(a, b) == best[-1][-1]


def test_greedy_match(spark):
    rng = np.random.default_rng(0)
    vectors = {w: rng.normal(size=4) for w in "abcde"}
    words = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in vectors.items()], "word string, vector array<double>")
    df = pairs(spark, ("a b zz", "c d e"), ("zz", "a"))
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    sims = np.array([unit["a"], unit["b"]]) @ np.array([unit[w] for w in "cde"]).T
    p, r = sims.max(1).mean(), sims.max(0).mean()
    rows = {x.pair_id: x for x in overlap.greedy_match_score(df, words).collect()}
    assert rows[0].precision == pytest.approx(p) and rows[0].recall == pytest.approx(r)
    assert rows[0].f1 == pytest.approx(2 * p * r / (p + r)) and rows[1].f1 == 0.0
    means = overlap.evaluate(df, words).first()
    assert means.match_f1 == pytest.approx(rows[0].f1 / 2)
    assert overlap.evaluate(df.limit(0), words).first().rouge_1 is None


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean_text string")


def test_modes(spark):
    with pytest.raises(ValueError):
        summarize.summarize(docs(spark, "x"), mode="other")
    empty = jobs.summaries(docs(spark, "", "One two. Three four.")).collect()
    assert {r.doc_id: r.summary for r in empty} == {0: "", 1: "One two. Three four."}


def test_best_sentences_in_text_order(spark):
    text = "Rare zebra quartz. the the the the. Plain words here. Odd xylem umbra."
    other = "the the plain words here. the plain words here."
    got = {r.doc_id: r.summary for r in jobs.summaries(docs(spark, text, other), mode="single", max_len=6).collect()}
    assert got[0] == "Rare zebra quartz. Odd xylem umbra."


def test_long_first_sentence_is_cut(spark):
    text = " ".join(f"w{i}" for i in range(50))
    got = jobs.summaries(docs(spark, text), mode="single", max_len=7).first().summary
    assert got == " ".join(f"w{i}" for i in range(7))


def test_hierarchical_two_passes_and_plug(spark):
    def first_words(units, keys, max_words):
        return units.select(*keys, summarize.head(units["text"], 3).alias("summary"))

    text = " ".join(f"a{i}" for i in range(800))
    got = summarize.summarize(docs(spark, text), summarizer=first_words).first().summary
    assert got == "a0 a1 a2"

    def make():
        return lambda texts: np.array([t.split()[0].upper() for t in texts])

    plug = summarize.batch_summarizer(make)
    assert summarize.summarize(docs(spark, text), summarizer=plug, mode="single").first().summary == "A0"


def test_whole_input_is_read(spark):
    text = "same " * 1030 + "words. Quartz xylem zebra."
    got = jobs.summaries(docs(spark, text, "same words"), mode="single", max_len=4).first().summary
    assert got == "Quartz xylem zebra."


def last_words(n):
    def run(units, keys, max_words):
        words = F.split("text", r"\s+")
        return units.select(*keys, F.array_join(F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n), " ").alias("summary"))

    return run


def test_last_chunk_reaches_the_final_pass(spark):
    text = " ".join(f"a{i}" for i in range(20 * 350)) + " end"
    model = last_words(90)
    model.max_input_words = 300
    seen = summarize.summarize(docs(spark, text), summarizer=model, max_len=90, max_len_final=90).first().summary
    assert len(seen.split()) == 90 and seen.endswith(" end")
    single = summarize.summarize(docs(spark, text, ""), summarizer=model, mode="single", max_len=90, max_len_final=90)
    assert {r.doc_id: r.summary[-4:] for r in single.collect()} == {0: " end", 1: ""}
    with pytest.raises(ValueError):
        summarize.summarize(docs(spark, text), summarizer=model, max_len=300)


def test_extraction_stays_in_the_row(spark, monkeypatch):
    rows = docs(spark, "Rare zebra quartz. the the the the. Plain words here. Odd xylem umbra.", "the the plain words here. the.", "", None)
    weights = summarize.term_weights(rows)
    for mode in summarize.MODES:
        made = summarize.summarize(rows, summarize.scorer(weights), mode=mode, max_len=6)
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        joined = summarize.summarize(rows, summarize.joined_totals(weights), mode=mode, max_len=6)
        assert sorted(made.collect()) == sorted(joined.collect())
    monkeypatch.setattr(summarize, "MAX_SHIPPED_TERMS", 0)
    assert summarize.scorer(weights).__qualname__.startswith("joined_totals")


def test_joined_totals_move_each_distinct_term_once(spark):
    """Terms go to the weights once per row, whatever their repeats, and come back as numbers."""
    text = "one two one two one. " * 50 + "three two!"
    rows = spark.createDataFrame([(1, text), (2, "one."), (3, None)], "doc_id long, clean_text string")
    weights = spark.createDataFrame([("one", 1.0), ("two", 2.0)], "term string, weight double")
    df = rows.select("doc_id", F.array(F.coalesce("clean_text", F.lit(""))).alias("_sentences"))
    df = df.withColumn("_sentences", F.array("_sentences"))
    shipped, joined = (f(weights)(df, "_sentences", "out") for f in (summarize.shipped_totals, summarize.joined_totals))
    assert sorted(map(repr, shipped.select("doc_id", "out").collect())) == sorted(map(repr, joined.select("doc_id", "out").collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1 and "uuid" not in plan


def test_a_part_gets_each_vector_once(spark):
    """No vector is held per pair and word; ids and words of vectors may repeat, an id may be null."""
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("b", [0.6, 0.8]), ("c", None)], "word string, vector array<double>")
    rows = [(1, "a a b", "b"), (2, "a", None), (None, "b", "a"), (3, "a", "zz"), (3, "zz", "b c"), (4, "", "")]
    scored = overlap.greedy_match_score(spark.createDataFrame(rows, "pair_id long, pred string, ref string"), words)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    found = {r.pair_id: (r.precision, r.recall) for r in scored.collect()}
    # "a" twice at 0.6, "b" by both of its vectors; the reference's two vectors of "b" are in the prediction.
    assert found.pop(1) == pytest.approx(((2 * 0.6 + 1 + 1) / 4, 1.0))
    assert found.pop(None) == pytest.approx(((0 + 0.6) / 2, 0.6)) and found.pop(3) == pytest.approx((0.6, 0.3))
    assert found == {2: (0.0, 0.0), 4: (0.0, 0.0)}
