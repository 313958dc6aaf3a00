import zlib

import numpy as np
from helpers import DOCS, empty, messy

from tomelight.llm import quality

LABELS = "doc_id long, quality int"


def made(spark, n=240):
    rng = np.random.default_rng(3)
    words = "the of and water river small house green tree walks often under bright morning".split()
    good = [" ".join(rng.choice(words, 60)) for _ in range(n)]
    bad = [" ".join(f"{rng.choice(words).upper()}!!" for _ in range(60)) for _ in range(n)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(len(texts))], LABELS)
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = made(spark)
    out = quality.score_documents(docs, labels).collect()
    assert len(out) == 480
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in out if r.held_out]
    assert len(held) > 80 and all(r.predicted == 1 - r.doc_id % 2 for r in held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.collect()} == {0}


def test_held_out_labels_are_not_read(spark):
    docs, labels = made(spark, 60)
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels.quality).otherwise(labels.quality))
    one, two = (sorted(quality.score_documents(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_features_by_hand():
    good, bad = (quality.compressor(x) for x in (b"the river runs " * 40, b"NOW!! BUY!! " * 40))
    text = b"the river runs and the river runs" * 60
    d, share, length = quality.features(text, good, bad)
    a, b = (sum(len(c.compress(text[i : i + 1024])) for i in range(0, len(text), 1024)) for c in (good, bad))
    assert d == (b - a) / (a + b) and d > 0 and share == a / (len(text) + 16) and length == np.log1p(len(text))


def test_messy_rows(spark):
    docs, labels = made(spark, 60)
    rows = messy(spark)
    model = quality.fit(docs, labels.union(spark.createDataFrame([(None, 1), (3, None), (5, 9)], LABELS)))
    out = quality.score(rows, model).collect()
    assert len(out) == 9 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.score_documents(rows, none).collect()} == {0.5}
    only = spark.createDataFrame([(5, 1), (6, 1)], LABELS)
    assert {r.score for r in quality.score_documents(rows, only).collect()} == {1.0}
    assert quality.score_documents(empty(spark), labels).collect() == []
    assert quality.keep_good(rows, none, threshold=0.4).columns == rows.columns
