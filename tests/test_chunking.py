import pytest
from pyspark.sql import functions as F

from tomelight.operators import chunking
from tomelight.sources import store


def pieces(spark, text, **sizes):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(chunking.chunk_array(F.col("t"), **sizes)).first()[0]


def word_text(n, stop_after=None):
    words = ["abcd"] * n
    if stop_after:
        words[stop_after - 1] = "abcd."
    return " ".join(words)


@pytest.mark.parametrize(
    "text, sizes",
    [
        (word_text(99), [99]),
        (word_text(100), [100]),
        (word_text(440), [400]),
        (word_text(450), [400, 100]),
        (word_text(400, 60), []),
        (word_text(400, 50), [400]),
        ("   \n ", []),
        ("", []),
    ],
)
def test_windows(spark, text, sizes):
    assert [len(c.split()) for c in pieces(spark, text)] == sizes


def test_lossless_windows_hold_every_word(spark):
    for n in (99, 100, 399, 400, 449, 450, 800, 1234):
        text = " ".join(f"w{i}." for i in range(n))
        found = [c.split() for c in pieces(spark, text, lossless=True)]
        assert {w for c in found for w in c} == set(text.split())
        assert all(c[0] == f"w{350 * i}." and 100 <= len(c) < 500 or n < 100 for i, c in enumerate(found))
    df = spark.createDataFrame([(1, "f", "short"), (2, "f", "word " * 150)], "doc_id long, filename string, t string")
    rows = chunking.chunk(df, "t", lossless=True, min_document_chars=0).collect()
    assert [(r.doc_id, r.num_words) for r in rows] == [(1, 1), (2, 150)]


def test_sections(spark):
    text = "Intro\n1. Open it\nWARNING hot\nnotes: ok"
    assert pieces(spark, text) == ["Intro", "1. Open it", "WARNING hot", "notes: ok"]


def test_heading_reaches_across_lines(spark):
    text = "Start here.\nSome words\nand more: end"
    assert pieces(spark, text) == ["Start here.", "Some words", "and more: end"]


def test_random_texts(spark):
    """A kept window is the longest prefix that ends on a mark after 70 % of the size in characters."""
    import random
    import re

    random.seed(5)
    size, step, least = 120, 90, 40
    far = re.compile(r".{%d,}[.:]" % (size * 7 // 10 + 1))
    for _ in range(15):
        n = random.randint(least, 900)
        words = ["x" * random.randint(1, 9) + random.choice(["", "", "", ".", ":", ","]) for _ in range(n)]
        windows = [" ".join(words[i : i + size]) for i in range(0, n, step)]
        trimmed = [m.group() if (m := far.match(w)) else w for w in windows]
        expected = [t for t in trimmed if t.count(" ") + 1 >= least]
        got = pieces(spark, " ".join(words), max_chunk_size=size, overlap=size - step, min_chunk_size=least)
        assert got == expected


def test_argument_checks():
    with pytest.raises(ValueError):
        chunking.chunk_array(F.col("t"), max_chunk_size=50, overlap=50)
    with pytest.raises(ValueError):
        chunking.chunk_array(F.col("t"), max_chunk_size=0, overlap=0)


def test_flags(spark):
    df = spark.createDataFrame(
        [("Caution: hot",), ("1. Open",), ("step 2 close",), ("Do step 2",), ("a|b|c|d|e",), ("size: 5",), (r"x :\s*\d y",)],
        "c string",
    )
    c = F.col("c")
    rows = df.select(chunking.is_warning(c), chunking.is_procedure(c), chunking.has_table(c)).collect()
    assert [tuple(r) for r in rows] == [
        (True, False, False),
        (False, True, False),
        (False, True, False),
        (False, False, False),
        (False, False, True),
        (False, False, False),
        (False, False, True),
    ]


def test_chunk_table_and_ids(spark):
    ids = [2**50, 7, 3, -4, 2**21]
    texts = [word_text(450), "too short", word_text(120), word_text(1200), word_text(30)]
    df = spark.createDataFrame(
        [(i, f"f{i}", t) for i, t in zip(ids, texts)] + [(1, "n", None)],
        "doc_id long, filename string, clean_text string",
    ).repartition(3)
    rows = sorted(chunking.number_chunks(chunking.chunk(df)).collect(), key=lambda r: r.chunk_id)
    assert [r.chunk_id for r in rows] == list(range(len(rows)))
    assert [(r.doc_id, r.chunk_index) for r in rows] == sorted((r.doc_id, r.chunk_index) for r in rows)
    assert {r.doc_id for r in rows} == {2**50, 3, -4, 2**21}
    assert all(r.num_words == len(r.chunk_text.split()) for r in rows)
    placed = chunking.number_in_order(store.materialize(chunking.chunk_in_order(df)))
    assert sorted(placed.select(chunking.number_chunks(chunking.chunk(df)).columns).collect()) == sorted(
        chunking.number_chunks(chunking.chunk(df)).collect()
    )
    texts = {r.doc_id: r.text for r in chunking.reassemble(chunking.chunk(df)).collect()}
    assert texts[3] == word_text(120) and texts[2**50].count("\n\n") == 1


def test_numbering_moves_no_chunk_text(spark):
    df = spark.createDataFrame([(i, f"f{i}", word_text(200 * i)) for i in range(9)], "doc_id long, filename string, clean_text string")
    made = chunking.chunk_in_order(df)
    exchanged = [x for x in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert len(exchanged) == 1 and "rangepartitioning(doc_id" in exchanged[0]
    text = chunking.number_in_order(store.materialize(made))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "chunk_text" not in "".join(x for x in text.splitlines() if "Exchange" in x)
