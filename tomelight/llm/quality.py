"""Quality scores from conditional compression.

Two zstandard dictionaries are built, one from pieces of texts labelled good and
one from pieces of texts labelled bad. A text is cut into pieces of ``PIECE`` bytes and
each is compressed with either dictionary; the difference of the summed sizes, over
their sum, says which kind the text resembles. A logistic curve over that
difference, the compressed share of the text and its length, fitted on labelled texts
that no dictionary has seen and weighted to the labels' true frequencies, turns it
into a probability.

Fitting reads at most ``dictionary_rows`` + ``calibration_rows`` labelled texts of
each class, chosen by a hash of their id among all usable labels, and puts at most
``sample_pieces`` pieces of a text into a dictionary. Scoring covers every
text whole, in the task that reads it.

Defined results: a null text counts as empty and is scored like any other; rows with
a null doc_id are scored and not held out; without labels of both classes the score
is the share of good labels (0.5 without labels). Repeated rows are scored alike and
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .token_files import slices

PIECE = 1024
LEVEL = 3
DICTIONARY_BYTES = 32768
#: Pieces of a text that go into a dictionary.
SAMPLE_PIECES = 4
THRESHOLD = 0.7
#: Bytes of text that a Python worker scores at a time.
SLICE_BYTES = 1_000_000
#: Remainder of the checksum that marks held-out rows, and its divisor.
HELD_OUT, FOLDS = 2, 4


def held_out(id: Column | str = "doc_id") -> Column:
    """Whether labels of a document may not be learned from."""
    column = F.col(id) if isinstance(id, str) else id
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Classifier:
    """Two dictionaries and a curve; ``prior`` alone where there is nothing to compare."""

    good: bytes = b""
    bad: bytes = b""
    prior: float = 0.5
    mean: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray | None = None


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False, write_checksum=False
    )


def features(data, good, bad) -> tuple[float, float, float]:
    """Normalised size difference, compressed share and log length of a text."""
    n = len(data)
    pieces = [data[i : i + PIECE] for i in range(0, n, PIECE)] or [b""]
    a = sum(len(good.compress(p)) for p in pieces)
    b = sum(len(bad.compress(p)) for p in pieces)
    return (b - a) / (a + b), a / (n + 16), float(np.log1p(n))


def curve(values: np.ndarray) -> np.ndarray:
    """The terms of the logistic curve: values, their products, and a constant."""
    n = values.shape[1]
    products = [values[:, i] * values[:, j] for i in range(n) for j in range(i, n)]
    return np.column_stack([np.ones(len(values)), values, *products])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton steps, halved while the loss grows."""

    def loss(w):
        p = sigmoid(x @ w)
        return -(weight * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum() + ridge / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (y - p)) - ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples, their own content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def measured(docs: DataFrame, model: Classifier, out: str, keep: str) -> DataFrame:
    """Features (``out`` = "features") or scores ("score") of whole texts, beside ``keep``."""
    kinds = {"features": "array<double>", "score": "double"}

    def run(batches):
        good, bad = compressor(model.good), compressor(model.bad)
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary())
            found = np.array(
                [features(memoryview(t.as_buffer()), good, bad) for t in texts]
            ).reshape(-1, 3)
            if out == "score":
                values = sigmoid(curve((found - model.mean) / model.scale) @ model.weights)
                column = pa.array(values, pa.float64())
            else:
                column = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(keep), column], [keep, out])

    rows = docs.select(keep, F.coalesce("text", F.lit("")).alias("_text"))
    kept = dict(rows.dtypes)[keep]
    return rows.mapInArrow(run, f"{keep} {kept}, {out} {kinds[out]}")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    dictionary_rows: int = 1000,
    calibration_rows: int = 4000,
    sample_pieces: int = SAMPLE_PIECES,
) -> Classifier:
    """Fit on ``labels`` (doc_id, quality) that are not held out; rows are per class.

    Of each text ``sample_pieces`` pieces, spread over it, go into its dictionary.
    """
    usable = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .distinct()
    )
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Classifier(prior=counts.get(1, 0) / total if total else 0.5)

    order = F.xxhash64("doc_id")
    ids = {
        c: [r[0] for r in usable.filter(F.col("quality") == c).orderBy(order, "doc_id").select("doc_id").limit(dictionary_rows + calibration_rows).collect()]
        for c in (0, 1)
    }
    # Of a small class, half goes into its dictionary.
    cut = {c: min(dictionary_rows, (len(ids[c]) + 1) // 2) for c in ids}
    spark = docs.sparkSession

    def those(chosen: dict[int, list]) -> DataFrame:
        rows = [(i, c) for c in chosen for i in chosen[c]]
        named = spark.createDataFrame(rows, "doc_id long, _class int")
        return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(named), "doc_id")

    def cut_pieces(batches):
        for batch in batches:
            out = []
            for i, c, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                data = (text.as_py() or "").encode()
                n = -(-len(data) // PIECE)
                starts = range(n) if n <= sample_pieces else [j * n // sample_pieces for j in range(sample_pieces)]
                out += [(i.as_py(), c.as_py(), j, data[j * PIECE : (j + 1) * PIECE]) for j in starts]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                    ["doc_id", "_class", "j", "piece"],
                )

    first = those({c: ids[c][: cut[c]] for c in ids}).select("doc_id", "_class", "text")
    found = first.mapInArrow(cut_pieces, "doc_id long, _class int, j int, piece binary").collect()
    samples = {c: [bytes(r["piece"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["j"])) if r["_class"] == c] for c in (0, 1)}
    if not samples[0] or not samples[1]:
        return Classifier(prior=counts[1] / total)
    model = Classifier(dictionary(samples[1]), dictionary(samples[0]), counts[1] / total)

    rest = those({c: ids[c][cut[c] :] or ids[c] for c in ids}).withColumn(
        "_key", F.struct("doc_id", "_class")
    )
    rows = measured(rest, model, "features", "_key").collect()
    values = np.array([r["features"] for r in rows]).reshape(-1, 3)
    y = np.array([r["_key"]["_class"] for r in rows], float)
    if len(set(y)) < 2:
        return Classifier(prior=counts[1] / total)
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum())) * len(y) / total
    model.mean, model.scale = values.mean(axis=0), values.std(axis=0) + 1e-9
    model.weights = fit_curve(curve((values - model.mean) / model.scale), y, weight)
    return model


def score(docs: DataFrame, model: Classifier, keep: str = "doc_id") -> DataFrame:
    """``keep`` and ``score``, 0 to 1: how likely each whole text is a good one."""
    if model.weights is None:
        return docs.select(keep, F.lit(float(model.prior)).alias("score"))
    return measured(docs, model, "score", keep)


def score_column(text: Column, model: Classifier) -> Column:
    """The score as a column: only texts go to the Python workers, in slices of bounded size."""
    if model.weights is None:
        return F.lit(float(model.prior))
    ready: list = []

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.extend([compressor(model.good), compressor(model.bad)])
        found = []
        for start, n in slices(texts, SLICE_BYTES):
            part = texts.slice(start, n).cast(pa.large_binary())
            found += [features(memoryview(t.as_buffer()), *ready) for t in part]
        values = (np.array(found).reshape(-1, 3) - model.mean) / model.scale
        return pa.array(sigmoid(curve(values) @ model.weights), pa.float64())

    return scored(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the usable labels and score all documents."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    value = score_column(F.col("text"), fit(docs, labels))
    scored = docs.select(F.struct(*docs.columns).alias("_row"), value.alias("_score"))
    return scored.filter(F.col("_score") >= threshold).select("_row.*")
