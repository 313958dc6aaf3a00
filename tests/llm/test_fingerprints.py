import hashlib
import re

import pytest
import regex
import xxhash
from helpers import empty, messy
from pyspark.sql import functions as F

from tomelight.llm import syncmers

SINGLE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
UNIT = regex.compile(rf"[{SINGLE}]|(?:(?![{SINGLE}])[\p{{L}}\p{{M}}\p{{N}}])+")


def chain(values):
    """Spark's xxhash64 of several values: each is hashed with the last hash as its seed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def brute(text, k=5, s=2):
    words = [chain([w]) for w in UNIT.findall(text.lower())]
    if not text:
        return []
    found = []
    small = [chain(words[i : i + s]) for i in range(len(words) - s + 1)]
    for i in range(len(words) - k + 1):
        window = small[i : i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            found.append(chain([small[i], small[i + 2], words[i + 4]]))
    return found or [chain(words) if words else chain([text])]


def digits(found):
    return "".join(f"{x & 0xFFFFFFFF:08x}" for x in found)


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["The quick brown fox jumps over the lazy dog. " * 3 + "End", "", "Ünïcode wörds ärë fine", "漢字かな交じり文 mixed text 12 34", "x", "a b c d e f g h i j k l m n o p"]


def test_against_brute_force(spark):
    rows = [(10 * i, t) for i, t in enumerate(TEXTS)]
    out = {r.doc_id: r for r in syncmers.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = out[id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == digits(brute(text)) and r.edited_fingerprint == digits(brute(edited))
        assert r.near_edited == pytest.approx(alike(brute(text), brute(edited)))
        assert r.near_next == pytest.approx(alike(brute(text), brute(following)))


def test_next_over_many_blocks(spark):
    ids = [i * i * 7919 for i in range(700)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    out = syncmers.with_next(df, "doc_id", ["doc_id", "text"]).collect()
    assert {r.doc_id: r.next.doc_id for r in out} == dict(zip(ids, ids[1:] + ids[:1]))


def test_a_passage_keeps_its_anchors(spark):
    passage = " ".join(f"word{i % 17}{i}" for i in range(60))
    texts = [passage, "before it comes this " + passage + " and that after"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    one, two = (r.a for r in df.select(syncmers.anchors(F.col("text")).alias("a")).collect())
    assert {a.hash for a in one} <= {a.hash for a in two}
    assert {b.pos - a.pos for a in one for b in two if a.hash == b.hash} == {4}


def test_messy_rows(spark):
    out = syncmers.edited_fingerprints(messy(spark)).collect()
    assert len(out) == 9
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == by[2].fingerprint == "" and by[3].fingerprint
    assert by[5].fingerprint == by[6].fingerprint and by[5].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 for r in out)
    assert syncmers.edited_fingerprints(empty(spark)).collect() == []
    one = spark.createDataFrame([(3, "abc def")], "doc_id long, text string")
    assert syncmers.edited_fingerprints(one).first().near_next == 1.0


def test_main_path_is_native(spark):
    text = syncmers.edited_fingerprints(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
