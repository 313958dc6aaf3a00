import itertools
import re

import numpy as np
import regex
from helpers import DOCS, empty, messy
from pyspark.sql import functions as F

from tomelight.llm import lines

WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def brute(rows, t=0.8, least=1):
    """Texts without repeated lines, every line compared with all earlier sets."""
    out, seen = [], []
    for id, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            words = frozenset(WORD.findall(line.lower()))
            if len(words) >= least:
                again = any(len(words & s) >= t * len(words | s) - 1e-9 for s in seen)
                seen.append(words)
                if again:
                    continue
            kept.append(line)
        out.append((id, "\n".join(kept), text.count("\n") + 1 - len(kept)))
    return out


def corpus(seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{int(x)}" for x in rng.zipf(1.3, 4000) % 900]
    base = [list(rng.choice(words, int(rng.integers(1, 30)))) for _ in range(60)]
    rows = []
    for id in range(80):
        text = []
        for _ in range(int(rng.integers(1, 9))):
            line = list(base[int(rng.integers(0, len(base)))])
            for _ in range(int(rng.integers(0, 4))):
                line[int(rng.integers(0, len(line)))] = str(rng.choice(words))
            rng.shuffle(line)
            text.append(" ".join(line))
        rows.append((id * 5, "\n".join(text)))
    return rows


def result(df, **options):
    return sorted((r.doc_id, r.text, r.n_dropped) for r in lines.drop_repeated(df, **options).collect())


def test_against_all_pairs(spark):
    for seed in (3, 4):
        rows = corpus(seed)
        expected = brute(rows)
        assert sum(n for _, _, n in expected) > 50
        assert result(spark.createDataFrame(rows, DOCS).repartition(5)) == expected


def test_by_shuffle_as_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    rows = corpus(6)
    assert result(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_group_of_variants_makes_few_pairs(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*words, f"own{i}", f"more{i}"])) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS)
    assert [r for r in result(df) if r[1]] == [(0, rows[0][1], 0)]
    sets = lines.line_sets(df, 3)
    found = lines.matches(sets, lines.slot_counts(sets), 0.8)
    assert found.count() == 299  # not 300 * 299 / 2


def test_lines_that_share_words_one_by_one_do_not_meet(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.choice(400, 12, replace=False))) for i in range(300)]
    met, given = [], lines.earlier_pairs

    def recorded(earlier, later, t):
        met.append(later.count())
        return given(earlier, later, t)

    monkeypatch.setattr(lines, "earlier_pairs", recorded)
    assert result(spark.createDataFrame(rows, DOCS)) == brute(rows)
    assert sum(met) < 300  # about 3 * 300 by single words


def test_group_whose_first_line_is_unlike_the_others(spark):
    # Each line is like the next ones only; the order of the lines is not that of their likeness.
    order = np.random.default_rng(9).permutation(150)
    rows = [(int(i), " ".join(f"w{j}" for j in range(n, n + 30))) for i, n in enumerate(order)]
    assert result(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_other_similarities(spark):
    rows = corpus(8)
    df = spark.createDataFrame(rows, DOCS)
    for t in (0.6, 0.75, 0.9):
        assert result(df, similarity=t) == brute(rows, t)


def test_runs_lose_nothing():
    # Two sets as a random order of shared words and of words of either alone.
    rng = np.random.default_rng(2)
    for t, _ in itertools.product((0.75, 0.8, 0.9), range(4000)):
        shared = int(rng.integers(1, 40))
        differ = int(shared * (1 - t) / t + 1e-9)
        if not differ:
            continue
        sides = [*["xy"] * shared, *rng.choice(["x", "y"], differ)]
        rng.shuffle(sides)
        found = []
        for side in "xy":
            words = [i for i, s in enumerate(sides) if side in s]
            number = min(len(words) - 1, int(len(words) * 2 * (1 - t) + 1e-9) + 1)
            found.append({(words[i], words[i + 1]) for i in range(number)})
        assert found[0] & found[1]


def test_short_lines_meet(spark):
    words = [f"w{i}" for i in range(9)]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate((4, 5, 6, 7, 9))]
    expected = brute(rows)
    assert sum(n for _, _, n in expected) >= 2
    assert result(spark.createDataFrame(rows, DOCS)) == expected


def test_bitmaps_differ_in_no_more_bits_than_sets_in_words(spark):
    rng = np.random.default_rng(1)
    sets = [[int(w) for w in rng.integers(-(2**31), 2**31, int(rng.integers(1, 90)))] for _ in range(60)]
    sets += [s[3:] + [i] for i, s in enumerate(sets)]
    df = spark.createDataFrame([(s,) for s in sets], "words array<int>")
    found = df.select("words", lines.bitmap(F.col("words"), 0), lines.bitmap(F.col("words"), 1)).collect()
    for x, y in itertools.combinations(found, 2):
        bits = sum(((x[i] ^ y[i]) & (2**64 - 1)).bit_count() for i in (1, 2))
        assert bits <= len(set(x[0]) ^ set(y[0]))


def test_filters_lose_nothing():
    t = 0.8
    for n, m in itertools.product(range(1, 25), repeat=2):
        for shared in range(1, min(n, m) + 1):
            if shared >= t * (n + m - shared):
                assert min(n, m) >= t * max(n, m) - 1e-9
                # The first shared word stands where at least ``shared`` words are left.
                assert n - (n - int(np.ceil(t * n - 1e-9)) + 1) + 1 <= shared


def test_messy_rows(spark):
    df = messy(spark, [(9, "A plain line, of WORDS\nnew words stand here"), (10, "one\none\none")])
    for name in ("_v", "_gone", "_doc", "gone", "version", "row"):
        df = df.withColumn(name, F.lit("clash"))
    out = lines.drop_repeated(df)
    assert out.filter(" OR ".join(f"{c} <> 'clash'" for c in ("_v", "_gone", "_doc", "gone", "version", "row"))).isEmpty()
    assert set(out.columns) == {*df.columns, "n_lines", "n_dropped"}
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_dropped))
    assert rows[1] == [(None, 0, 0)] and rows[2] == [("", 1, 0)] and rows[3] == [("!!! ???", 1, 0)]
    assert rows[5][0][2] == 0 and rows[6] == [("", 1, 1)]
    assert rows[7] == [("a plain line of words\nsecond line of other words\n\n", 4, 0)] * 2
    assert rows[9] == [("new words stand here", 2, 1)] and rows[10] == [("", 3, 3)]
    assert rows[None][0][2] == 0
    assert lines.drop_repeated(empty(spark)).collect() == []


def test_lines_of_few_words(spark):
    rows = corpus(7)
    rows += [(1000 + i, f"one\n{'again ' * 50}\ntwo words\nwords  two\n\n--\nthree short words\nthree short") for i in range(30)]
    expected = brute(rows, least=1)
    assert expected[-1][1:] == ("\n--", 6) and expected[-30][2] == 1
    assert result(spark.createDataFrame(rows, DOCS).repartition(5), least=1) == expected


def test_every_line_of_the_registered_query(spark, tmp_path):
    import corpus_pipeline
    from tomelight.llm import queries

    rows = [(1, "one\none two\n\none"), (2, "one two\n\nrest of it all\nONE!")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "length(text) as n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    left = [(1, "one\none two\n"), (2, "\nrest of it all")]
    assert sorted((r.doc_id, r.text) for r in queries.op8_lines(spark, str(tmp_path)).collect()) == left
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.line_dedup(spark, df, "").select("doc_id", "text").collect()) == left


def test_main_path_is_native(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    for made in (lines.line_sets(df, 3), lines.repeated_lines(df), lines.drop_repeated(df)):
        assert not re.search("Python|Pandas|Arrow", made._jdf.queryExecution().executedPlan().toString())
