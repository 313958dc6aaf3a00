import pytest
from pyspark.sql import functions as F

from tomelight.functions import text as tx
from tomelight.operators import corpus, joins


def apply(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a\n\n b\t c", "a b c"),
        ("Homepage 3 x", "Home x"),
        ("use RS232 cable now", "use now"),
        ("see Part 12 here", "see here"),
        ("fig 3-14 15 end", "fig end"),
        ("x y\u0085z", "x y z"),
        ("PÁGINA 7 fin", "fin"),
        ("a b\x1cc", "a b c"),
        ("bell\x07 3", "bell 3"),
        ("use the Hydraulic system with a valve 4. done", "use the . done"),
        ("Functions and operation x Hydraulic system y valve 3 z valve 4", "z valve 4"),
        ("counterpart 12 stays", "counterpart 12 stays"),
        ("éAB12 stays", "éAB12 stays"),
        ("AB12é stays", "AB12é stays"),
        ("AB12, AB34é x", "AB34é x"),
    ],
)
def test_clean(spark, raw, expected):
    assert apply(spark, tx.clean, [raw]) == [expected]


def test_clean_without_boilerplate(spark):
    text = "Hydraulic system valve 4"
    assert apply(spark, lambda c: tx.clean(c, []), [text]) == [text]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("I don't know.", ["I", "do", "n't", "know", "."]),
        ("it's the device's, 3.5 volts: 3,000", ["it", "'s", "the", "device", "'s", ",", "3.5", "volts", ":", "3,000"]),
        ("re-start and/or (see below).", ["re-start", "and/or", "(", "see", "below", ")", "."]),
        ("End. Next one", ["End", ".", "Next", "one"]),
        ("they'll we've", ["they", "'ll", "we", "'ve"]),
        ("wait...what--now?!", ["wait", "...", "what", "--", "now", "?", "!"]),
        ("", []),
    ],
)
def test_tokens(spark, raw, expected):
    assert apply(spark, tx.tokens, [raw]) == [expected]


def test_keep_alnum(spark):
    words = ["re-start", "3.5", "n't", "and/or", "x200", "ñu"]
    assert apply(spark, tx.keep_alnum, [words], "v array<string>") == [["x200", "ñu"]]


def test_stop_words_keep_repeats(spark):
    words = ["the", "pump", "and", "pump"]
    assert apply(spark, tx.drop_stop_words, [words], "v array<string>") == [["pump", "pump"]]


def test_s_stem(spark):
    words = ["queries", "boxes", "pumps", "glass", "status", "toes", "aaies", "as", "gas"]
    expected = ["query", "boxe", "pump", "glass", "status", "toes", "aaies", "as", "ga"]
    assert apply(spark, tx.s_stem, words) == expected


def test_sentences(spark):
    assert apply(spark, tx.sentences, ["One. Two! Three? four.five"]) == [
        ["One.", "Two!", "Three?", "four.five"]
    ]


def test_term_counts_and_ngrams(spark):
    rows = apply(spark, tx.term_counts, [["b", "a", "b", None], [], None], "v array<string>")
    assert [(r.term, r.tf) for r in rows[0]] == [("a", 1), ("b", 2)]
    assert rows[1] == []
    grams = apply(spark, lambda c: tx.ngrams(c, 2), [["a", "b", "c"], ["a"], []], "v array<string>")
    assert grams == [["a b", "b c"], [], []]


def test_process_document(spark):
    df = spark.createDataFrame(
        [(1, "a", "The pumps don't start. Check 3.5 volts!"), (2, "b", ""), (3, "c", "the and")],
        "doc_id long, filename string, raw_text string",
    )
    rows = corpus.build_corpus(df).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.tokens == ["pumps", "start", "check", "volts"]
    assert row.lemmas == ["pump", "start", "check", "volt"]
    assert (row.num_tokens, row.num_sentences) == (4, 2)


def test_empty_corpus_keeps_schema(spark):
    df = spark.createDataFrame([], "doc_id long, filename string, raw_text string")
    out = corpus.build_corpus(df)
    assert out.columns == ["doc_id", *corpus.PROCESSED] and out.count() == 0
    stats = corpus.corpus_stats(out).first()
    assert stats.total_documents == 0 and stats.unique_tokens == 0
    assert corpus.length_histogram(out).count() == 0


def test_plugged_stemmer(spark):
    df = spark.createDataFrame([(1, "a", "pumping pumps")], "doc_id long, filename string, raw_text string")
    out = corpus.analyze(df, stemmer=lambda w: F.left(w, F.lit(4)))
    assert out.first().tokens_stemmed == ["pump", "pump"]


def test_lemmatize_in_order_and_salted(spark):
    docs = spark.createDataFrame(
        [(1, ["pumps", "ran", "pumps", "xx"]), (2, [])], "doc_id long, tokens array<string>"
    )
    lexicon = spark.createDataFrame([("pumps", "pump"), ("ran", "run"), ("xx", "the")], "form string, lemma string")
    out = {r.doc_id: r.lemmas for r in corpus.lemmatize(docs, lexicon).collect()}
    assert out == {1: ["pump", "run", "pump"], 2: []}
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1)], "k string, i long")
    right = spark.createDataFrame([("hot", 1.0), ("cold", 2.0)], "k string, x double")
    salted = joins.salted_join(left, right, "k", "i", salts=4, hot_rows=10, max_broadcast_rows=1)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 2, 25]], "num_tokens int")
    rows = {r.bin: r.n for r in corpus.length_histogram(df).collect()}
    assert rows[1] == 1 and rows[2] == 1 and rows[3] == 1 and rows[25] == 1 and len(rows) == 25
    same = spark.createDataFrame([(4,), (4,)], "num_tokens int")
    one = {r.bin: r.n for r in corpus.length_histogram(same).collect()}
    assert one[13] == 2 and sum(one.values()) == 2


def test_corpus_string(spark):
    df = spark.createDataFrame([(["a", None, "b"],), (None,)], "lemmas array<string>")
    assert [r.corpus for r in corpus.corpus_string(df).collect()] == ["a b", ""]
    other = spark.createDataFrame([(7,)], "lemmas int")
    assert corpus.corpus_string(other).first().corpus == "7"
