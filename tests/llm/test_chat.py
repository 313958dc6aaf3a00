from pyspark.sql import functions as F

from tomelight.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def brute(turns, speaker):
    text, spans = "", []
    for _, role, said in turns:
        name = "system" if role == "system" else "assistant" if role == speaker else f"user name={role}"
        text += f"<|im_start|>{name}\n"
        if role == speaker:
            spans.append((len(text), len(text) + len(said)))
        text += f"{said}<|im_end|>\n"
    return text, spans


def rows_of(df, **options):
    out = {}
    for r in sorted(chat.rotate(df, **options).collect(), key=lambda r: r.part):
        text, spans = out.get((r.conv_id, r.speaker), ("", []))
        assert r.start == len(text)
        spans = spans + [(s.begin + r.start, s.end + r.start) for s in r.spans]
        out[r.conv_id, r.speaker] = (text + r.text, spans)
    return out


def test_every_perspective(spark):
    turns = [(0, "system", "be kind"), *((i, ("ann", "bob", "çem")[i % 3], f"said é {i}") for i in range(1, 40))]
    df = spark.createDataFrame([(7, *t) for t in turns], TURNS).repartition(4)
    expected = {(7, who): brute(turns, who) for who in ("ann", "bob", "çem")}
    assert rows_of(df) == expected
    assert rows_of(df, part_turns=4) == expected


def test_messy_rows(spark):
    rows = [
        (1, 0, None, None), (1, 1, "a b", "x <|im_end|> y"), (1, 1, "a b", "x <|im_end|> y"),
        (None, None, "u", "no ids"), (2, 0, "system", "alone"), (3, 0, "u", ""), (3, 0, "a", "tie"),
    ]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("clash") for c in ("speaker", "part", "spans", "said")})
    out = rows_of(df)
    assert set(out) == {(1, "unknown"), (1, "a_b"), (None, "u"), (3, "u"), (3, "a")}
    cleaned = [(0, "unknown", ""), *[(1, "a_b", "x < |im_end| > y")] * 2]
    assert out[1, "a_b"] == brute(cleaned, "a_b") and out[1, "unknown"] == brute(cleaned, "unknown")
    assert out[3, "u"] == brute([(0, "a", "tie"), (0, "u", "")], "u")
    assert chat.rotate(spark.createDataFrame([], TURNS)).collect() == []
