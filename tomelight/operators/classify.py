"""Question classification: splits, models, answers, prompts and metrics."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions import vectors as vx
from ..functions.constants import INTENTS, PROMPT_TEMPLATE, TEST_QUESTIONS
from ..sources.store import materialize
from . import topk
from .joins import lookup, salted_join

FALLBACK = "other"
TOLERANCE = 1e-3


def built_in_test_set(spark: SparkSession) -> DataFrame:
    """The labelled questions shipped with the library: question, intent."""
    rows = [(q, intent) for intent, questions in TEST_QUESTIONS.items() for q in questions]
    return spark.createDataFrame(rows, "question string, intent string")


def split_positional(
    df: DataFrame, share: float = 0.1, pos: str = "pos"
) -> tuple[DataFrame, DataFrame]:
    """The first ``floor(share * n)`` rows by position, and the rest."""
    bound = df.select(F.floor(F.lit(share) * F.count(F.lit(1)))).scalar()
    return df.filter(F.col(pos) < bound), df.filter(F.col(pos) >= bound)


def split_stratified(
    df: DataFrame, label: str, id: str, share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Mark ``round(share * n)`` rows of each class as validation: adds is_validation.

    Rows are taken in the order of a seeded hash. The hash order of a class is
    cut into 4096 slices whose counts are summed first, so a class that holds
    most rows is never ordered in one task.
    """
    digest = F.md5(F.concat_ws("#", F.col(id).cast("string"), F.lit(str(seed))))
    rows = df.withColumn("_h", digest).withColumn("_slice", F.left("_h", F.lit(3)))
    slices = rows.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    per_class = Window.partitionBy(label)
    slices = slices.select(
        label,
        "_slice",
        F.round(F.lit(share) * F.sum("_n").over(per_class)).cast("long").alias("_quota"),
        (
            F.sum("_n").over(
                per_class.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("_n")
        ).alias("_before"),
    )
    order = Window.partitionBy(label, "_slice").orderBy("_h", id)
    return (
        rows.join(slices, [label, "_slice"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(order))
        .withColumn("is_validation", F.col("_rank") <= F.col("_quota"))
        .drop("_h", "_slice", "_quota", "_before", "_rank")
    )


def encode_labels(df: DataFrame, label: str, out: str = "label_index") -> DataFrame:
    """Number the labels alphabetically from 0."""
    codes = df.select(label).distinct()
    codes = codes.withColumn(out, (F.row_number().over(Window.orderBy(label)) - 1))
    return lookup(df, codes, label)


def decode_labels(df: DataFrame, codes: DataFrame, label: str, code: str = "label_index"):
    """Back from numbers to labels, given the coding table."""
    return lookup(df, codes.select(code, label).distinct(), code)


def default_gamma(df: DataFrame, vector: str = "embedding") -> float:
    """One over dimension times variance of the vectors; 1 where they do not vary."""
    spread = df.select(F.explode(vector).alias("x")).agg(F.var_pop("x")).first()[0]
    return 1.0 / (vx.dimension(df, vector) * spread) if spread else 1.0


def rbf_features(
    df: DataFrame,
    vector: str = "embedding",
    out: str = "embedding",
    gamma: float | None = None,
    features: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Random Fourier features (Rahimi and Recht, 2007) of the RBF kernel.

    A linear classifier on them approximates the kernel classifier. ``gamma``
    defaults to one over dimension times variance of the vectors; the same
    gamma and seed must be given for training and prediction.
    """
    dim = vx.dimension(df, vector)
    gamma = default_gamma(df, vector) if gamma is None else gamma
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2 * gamma), size=(dim, features))
    phases = rng.uniform(0, 2 * np.pi, size=features)

    @F.pandas_udf("array<double>")
    def project(rows: pd.Series) -> pd.Series:
        x = np.stack(rows.to_list()) if len(rows) else np.zeros((0, dim))
        return pd.Series(list(np.sqrt(2.0 / features) * np.cos(x @ weights + phases)))

    return df.withColumn(out, project(vx.as_double(F.col(vector))))


def train(
    df: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    c: float = 1.0,
    max_iter: int = 20,
    threads: int = 8,
) -> PipelineModel:
    """One linear support-vector machine per class against the rest.

    ``c`` weighs errors against the margin as usual; ``threads`` classes are
    fitted at a time.
    """
    rows = df.withColumn("_x", array_to_vector(vx.as_double(F.col(vector))))
    indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc")
    coded = indexer.fit(rows)
    penalty = 1.0 / (c * max(1, df.count()))
    svm = OneVsRest(
        classifier=LinearSVC(maxIter=max_iter, tol=TOLERANCE, regParam=penalty),
        featuresCol="_x",
        labelCol="_y",
        predictionCol="_p",
        parallelism=threads,
    ).fit(coded.transform(rows))
    decode = IndexToString(inputCol="_p", outputCol="predicted", labels=coded.labels)
    return PipelineModel([svm, decode])


def predict(model: PipelineModel | None, df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add the predicted label; an untrained model is an error."""
    if model is None:
        raise RuntimeError("train a model before predicting")
    rows = df.withColumn("_x", array_to_vector(vx.as_double(F.col(vector))))
    return model.transform(rows).drop("_x", "_p", "rawPrediction")


def train_metrics(
    df: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    id: str = "id",
    validation_split: float = 0.2,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Train on the stratified rest and report both sides in one row."""
    # Training reads the rows many times; they start from a written table.
    rows = materialize(split_stratified(df, label, id, validation_split, seed))
    model = train(rows.filter(~F.col("is_validation")), vector, label)
    scored = predict(model, rows, vector).select(
        F.col(label).alias("true"), F.col("predicted").alias("pred"), "is_validation"
    )
    held_out = scored.filter("is_validation")
    hit = (F.col("true") == F.col("pred")).cast("double")
    return model, scored.agg(
        F.avg(F.when(~F.col("is_validation"), hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("is_validation"), hit)).alias("val_accuracy"),
        macro_f1(held_out, "true", "pred").scalar().alias("val_f1_macro"),
        F.count(F.when(~F.col("is_validation"), 1)).alias("n_train"),
        F.count(F.when(F.col("is_validation"), 1)).alias("n_val"),
        F.count_distinct(F.when(~F.col("is_validation"), F.col("true"))).alias("n_classes"),
    )


def centroids(df: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per class: label, embedding."""
    mean = vx.means(F.col(vector), vx.dimension(df, vector))
    return df.groupBy(F.col(label).cast("string").alias("label")).agg(mean.alias("embedding"))


def nearest_centroid(
    df: DataFrame,
    classes: DataFrame,
    id: str = "id",
    vector: str = "embedding",
    min_score: float | None = None,
    **blocks,
) -> DataFrame:
    """The class whose centroid is most similar: id, predicted, score.

    Below ``min_score`` the answer is ``other``.
    """
    found = topk.nearest(
        topk.side(df, id, vector, None, None),
        topk.side(classes, "label", "embedding", None, None),
        1,
        **blocks,
    )
    label = F.col("item_id")
    if min_score is not None:
        low = F.round("score", topk.DIGITS) < min_score
        label = F.when(low, F.lit(FALLBACK)).otherwise(label)
    return found.select(F.col("query_id").alias(id), label.alias("predicted"), "score")


def nearest_examples(
    df: DataFrame,
    examples: DataFrame,
    k: int = 5,
    id: str = "id",
    example_id: str = "id",
    label: str = "label",
    vector: str = "embedding",
    skip_self: bool = False,
    min_score: float | None = None,
    **blocks,
) -> DataFrame:
    """Majority label of the k nearest labelled examples: id, predicted, votes, score.

    Ties go to the higher summed similarity, then to the alphabetically first
    label. Below ``min_score`` for the nearest example the answer is ``other``.
    """
    near = topk.nearest(
        topk.side(df, id, vector, None, None),
        topk.side(examples, example_id, vector, None, None),
        k,
        skip_self=skip_self,
        **blocks,
    )
    known = examples.select(
        F.col(example_id).alias("item_id"), F.col(label).cast("string").alias("label")
    )
    # An example near to many rows is a frequent key.
    voters = salted_join(near, known, "item_id", "query_id", how="inner")
    votes = voters.groupBy("query_id", "label").agg(
        F.count(F.lit(1)).alias("votes"),
        F.sum("score").alias("total"),
        F.max("score").alias("top"),
    )
    best = votes.groupBy("query_id").agg(
        F.min(
            F.struct(
                (-F.col("votes")).alias("v"),
                (-F.round("total", topk.DIGITS)).alias("t"),
                F.col("label"),
            )
        ).alias("_b"),
        F.max("top").alias("score"),
    )
    predicted = F.col("_b.label")
    if min_score is not None:
        predicted = F.when(F.col("score") < min_score, F.lit(FALLBACK)).otherwise(predicted)
    return best.select(
        F.col("query_id").alias(id),
        predicted.alias("predicted"),
        (-F.col("_b.v")).alias("votes"),
        "score",
    )


def prediction_table(df: DataFrame, question: str, true: str, predicted: str) -> DataFrame:
    return df.select(
        F.col(question).alias("question"),
        F.col(true).alias("true_intent"),
        F.col(predicted).alias("predicted_intent"),
        F.col(true).eqNullSafe(F.col(predicted)).alias("is_correct"),
    )


def accuracy(df: DataFrame, true: str = "true", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(true) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, true: str = "true", pred: str = "pred") -> DataFrame:
    """Confusion counts over the labels present in truth: true, pred, n.

    Predictions outside those labels are dropped; empty cells count 0. The label
    grid is built from the labels alone.
    """
    pairs = df.groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    labels = pairs.select("true").distinct()
    every = labels.agg(F.sort_array(F.collect_list("true"))).scalar()
    cells = labels.select("true", F.explode(every).alias("pred"))
    return cells.join(pairs, ["true", "pred"], "left").select(
        "true", "pred", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def confusion_matrix(df: DataFrame, labels: list[str], true: str = "true", pred: str = "pred"):
    """The same counts as a matrix with one column per label."""
    return confusion(df, true, pred).groupBy("true").pivot("pred", labels).agg(F.sum("n"))


def per_label(
    df: DataFrame, true: str = "true", pred: str = "pred", labels: str = "union"
) -> DataFrame:
    """Precision, recall, F1 and support of each label; empty ratios are 0.

    ``labels="true"`` keeps only labels that occur in the truth.
    """
    if labels not in ("union", "true"):
        raise ValueError("labels must be 'union' or 'true'")
    # Pairs are counted first; each distinct pair then votes for its two labels.
    pairs = df.groupBy(
        F.col(true).cast("string").alias("t"), F.col(pred).cast("string").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    votes = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("t").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("correct"),
                ),
                F.struct(
                    F.col("p").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("correct"),
                ),
            )
        )
    )
    sums = votes.groupBy("label").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("correct").alias("correct"),
    )
    if labels == "true":
        sums = sums.filter("support > 0")
    zero = F.lit(0.0)
    return sums.select(
        "label",
        F.coalesce(F.try_divide("correct", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("correct", "support"), zero).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("correct") * 2.0, F.col("support") + F.col("predicted")), zero
        ).alias("f1"),
        "support",
    )


def macro_f1(
    df: DataFrame, true: str = "true", pred: str = "pred", labels: str = "union"
) -> DataFrame:
    return per_label(df, true, pred, labels).agg(F.avg("f1").alias("f1_macro"))


def report(
    df: DataFrame, true: str = "true", pred: str = "pred", labels: str = "union"
) -> DataFrame:
    """Per-label scores with the accuracy, macro and weighted average rows."""
    each = per_label(df, true, pred, labels)
    n = F.sum("support")

    def weighted(name: str) -> Column:
        total = F.sum(F.col(name) * F.col("support"))
        return F.coalesce(F.try_divide(total, n), F.lit(0.0)).alias(name)

    macro = each.agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
        n.alias("support"),
    )
    weighted_row = each.agg(
        F.lit("weighted avg").alias("label"),
        *[weighted(c) for c in ("precision", "recall", "f1")],
        n.alias("support"),
    )
    hit = F.avg((F.col(true) == F.col(pred)).cast("double"))
    overall = df.agg(
        F.lit("accuracy").alias("label"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        hit.alias("f1"),
        F.count(F.lit(1)).alias("support"),
    )
    return each.unionByName(overall).unionByName(macro).unionByName(weighted_row)


def normalize_answers(
    df: DataFrame, answer: str, intents: list[str] | None = None, out: str = "intent"
) -> DataFrame:
    """Map a model's raw answer to an intent.

    The first word without trailing punctuation decides; otherwise the first
    intent, in taxonomy order, that occurs anywhere in the answer.
    """
    known = list(INTENTS) if intents is None else list(intents)
    raw = F.lower(tx.strip(F.coalesce(F.col(answer), F.lit(""))))
    first = F.regexp_replace(F.get(tx.space_words(raw), F.lit(0)), r"[.,;:!?'\"]+$", "")
    inside = [F.when(F.contains(raw, F.lit(i)), F.lit(i)) for i in known]
    return df.withColumn(
        out,
        F.when(raw == "", F.lit(FALLBACK))
        .when(first.isin(known), first)
        .otherwise(F.coalesce(*inside, F.lit(FALLBACK))),
    )


def build_prompts(
    questions: DataFrame,
    examples: DataFrame,
    question: str = "question",
    example: str = "text",
    order: str = "pos",
    intents: dict[str, str] | None = None,
    template: str = PROMPT_TEMPLATE,
    out: str = "prompt",
    max_example_chars: int | None = None,
) -> DataFrame:
    """Fill the prompt template for every question.

    Examples are joined in order, without their labels. With ``max_example_chars``
    longer ones are refused before any is moved, as they would not fit a prompt.
    """
    if max_example_chars is not None:
        size = examples.agg(F.sum(F.length(example)).alias("n")).first()["n"] or 0
        if size > max_example_chars:
            raise ValueError(f"examples hold {size} characters, limit {max_example_chars}")
    taxonomy = INTENTS if intents is None else intents
    lines = "\n".join(f"- {k}: {v}" for k, v in taxonomy.items())
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(example).alias("_e"))))
    joined = examples.agg(F.array_join(F.transform(ordered, lambda e: e["_e"]), " | ")).scalar()
    slots = {
        "{intent_descriptions}": F.lit(lines),
        "{question}": F.translate(tx.strip(F.col(question)), '"', "'"),
        "{examples}": joined,
    }
    parts, rest = [], template
    for slot, value in slots.items():
        head, _, rest = rest.partition(slot)
        parts += [F.lit(head), value]
    return questions.withColumn(out, F.concat(*parts, F.lit(rest)))


def ask(
    df: DataFrame,
    make_model: Callable[[], Callable[[str], str]],
    prompt: str = "prompt",
    retries: int = 0,
) -> DataFrame:
    """Add ``answer``, ``latency_ms`` and ``failed`` from a plugged model.

    ``make_model`` runs once in each task and returns a function from a prompt to an
    answer. An exception is tried again ``retries`` times and then counts as a failure
    with the answer ``""``; the other prompts go on. A null prompt fails without a call.
    """

    def one(model: Callable[[str], str], text: str | None) -> tuple[str, float, bool]:
        start = time.perf_counter()
        for _ in range(retries + 1 if text is not None else 0):
            try:
                answer = model(text) or ""
                return answer, (time.perf_counter() - start) * 1000, False
            except Exception:
                continue
        return "", (time.perf_counter() - start) * 1000, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            found = [one(model, text) for text in batch.column(prompt).to_pylist()]
            columns = zip(*found, strict=True) if found else ([], [], [])
            added = [
                pa.array(list(values), kind)
                for values, kind in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    given = df.drop("answer", "latency_ms", "failed")
    added_types = {"answer": T.StringType(), "latency_ms": T.DoubleType(), "failed": T.BooleanType()}
    names = [*given.columns, *added_types]
    fields = [*given.schema.fields, *(T.StructField(n, t) for n, t in added_types.items())]
    return given.mapInArrow(run, T.StructType(fields))


def evaluate_answers(
    df: DataFrame,
    true: str = "label",
    pred: str = "intent",
    latency: str = "latency_ms",
    failed: str | None = None,
    by: str = "model",
) -> DataFrame:
    """Accuracy, macro F1 over labels in truth, and mean latency of each model.

    A failed call counts as ``other`` with a latency of 0.
    """
    bad = F.lit(False) if failed is None else F.coalesce(F.col(failed), F.lit(False))
    rows = df.select(
        F.col(by).alias("model"),
        F.col(true).alias("t"),
        F.when(bad, F.lit(FALLBACK)).otherwise(F.col(pred)).alias("p"),
        F.when(bad, F.lit(0.0)).otherwise(F.col(latency).cast("double")).alias("ms"),
    )
    pairs = rows.groupBy("model", "t", "p").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms").alias("ms")
    )
    totals = pairs.groupBy("model").agg(
        (F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
        (F.sum("ms") / F.sum("n")).alias("avg_inference_time_ms"),
        F.sum("n").alias("test_set_size"),
    )
    zero = F.lit(0).cast("long")
    votes = pairs.select(
        "model",
        F.inline(
            F.array(
                F.struct(
                    F.col("t").alias("label"),
                    F.col("n").alias("s"),
                    zero.alias("q"),
                    F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(zero).alias("c"),
                ),
                F.struct(
                    F.col("p").alias("label"), zero.alias("s"), F.col("n").alias("q"), zero.alias("c")
                ),
            )
        ),
    )
    scores = (
        votes.groupBy("model", "label")
        .agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("c").alias("c"))
        .filter("s > 0")
        .groupBy("model")
        .agg(F.avg(F.col("c") * 2.0 / (F.col("s") + F.col("q"))).alias("f1_macro"))
    )
    return totals.join(scores, "model").select(
        "model", "accuracy", "f1_macro", "avg_inference_time_ms", "test_set_size"
    )


