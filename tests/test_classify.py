import numpy as np
import pytest
from pyspark.sql import functions as F

from tomelight.functions.constants import INTENTS
from tomelight.operators import classify, positions
from tomelight.sources import store


@pytest.fixture(scope="module")
def published(spark):
    counts = {
        ("how_to", "how_to"): 2,
        ("how_to", "diagnose"): 5,
        ("how_to", "spec_query"): 1,
        ("spec_query", "spec_query"): 6,
        ("spec_query", "diagnose"): 1,
        ("diagnose", "diagnose"): 8,
        ("safety_check", "safety_check"): 1,
        ("safety_check", "diagnose"): 6,
    }
    rows = [pair for pair, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "true string, pred string")


def test_published_scores(published):
    f1 = {r.label: round(r.f1, 6) for r in classify.per_label(published).collect()}
    assert f1 == {"how_to": 0.4, "spec_query": 0.857143, "diagnose": 0.571429, "safety_check": 0.25}
    assert round(classify.accuracy(published).first()[0], 6) == 0.566667
    assert round(classify.macro_f1(published).first()[0], 6) == 0.519643
    report = {r.label: r for r in classify.report(published).collect()}
    assert report["accuracy"].support == 30 and round(report["macro avg"].f1, 6) == 0.519643
    assert round(report["weighted avg"].recall, 6) == 0.566667
    cells = {(r.true, r.pred): r.n for r in classify.confusion(published).collect()}
    assert cells[("how_to", "diagnose")] == 5 and cells[("diagnose", "how_to")] == 0 and len(cells) == 16
    wide = classify.confusion_matrix(published, ["diagnose", "how_to"]).filter(F.col("true") == "how_to").first()
    assert (wide.diagnose, wide.how_to) == (5, 2)


def test_label_sets(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "true string, pred string")
    assert round(classify.macro_f1(df).first()[0], 6) == 0.333333
    assert round(classify.macro_f1(df, labels="true").first()[0], 6) == 0.666667
    assert [tuple(r) for r in classify.confusion(df).collect()] == [("a", "a", 1)]
    with pytest.raises(ValueError):
        classify.macro_f1(df, labels="pred")


@pytest.mark.parametrize(
    "raw, intent",
    [
        ("How_To.", "how_to"),
        ("Intent: diagnose", "diagnose"),
        ('"how_to"', "how_to"),
        ("maybe summary or diagnose", "diagnose"),
        ("   ", "other"),
        ("refund", "other"),
        (None, "other"),
        (" SUMMARY!?", "summary"),
    ],
)
def test_normalize_answers(spark, raw, intent):
    df = spark.createDataFrame([(raw,)], "answer string")
    assert classify.normalize_answers(df, "answer").first().intent == intent


def test_prompt(spark):
    questions = spark.createDataFrame([(' Why "E1"? ',)], "question string")
    examples = spark.createDataFrame([(1, "second", "x"), (0, "first {question}", "y")], "pos int, text string, label string")
    prompt = classify.build_prompts(questions, examples).first().prompt
    assert "Question: \"Why 'E1'?\"" in prompt and '"first {question} | second"' in prompt
    assert "- other: None of the above." in prompt and prompt.count("- ") >= len(INTENTS)
    with pytest.raises(ValueError):
        classify.build_prompts(questions, examples, max_example_chars=10)
    long = examples.withColumn("text", F.repeat("text", 100000))
    assert len(classify.build_prompts(questions, long).first().prompt) > 2_000_000


def test_positional_split(spark):
    rows = positions.position_index(spark.range(218).withColumnRenamed("id", "i"), "i")
    first, rest = classify.split_positional(rows)
    assert (first.count(), rest.count()) == (21, 197) and first.agg(F.max("i")).first()[0] == 20


def test_stratified_split_is_exact(spark):
    rows = [(i, "hot" if i % 3 else "b" if i % 2 else "c") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label string")
    marked = classify.split_stratified(df, "label", "id", 0.2).collect()
    import hashlib

    for label in ("hot", "b", "c"):
        ids = sorted((hashlib.md5(f"{i}#42".encode()).hexdigest(), i) for i, x in rows if x == label)
        expected = {i for _, i in ids[: round(0.2 * len(ids))]}
        assert {r.id for r in marked if r.label == label and r.is_validation} == expected
    again = classify.split_stratified(df.repartition(5), "label", "id", 0.2).collect()
    assert sorted(marked) == sorted(again)


def blobs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(90):
        centre = np.eye(3)[i % 3] * 4
        rows.append((i, [float(x) for x in centre + rng.normal(scale=0.3, size=3)], "xyz"[i % 3]))
    return spark.createDataFrame(rows, "id long, embedding array<double>, label string")


def test_train_predict_store(spark, tmp_path):
    df = blobs(spark)
    model, metrics = classify.train_metrics(df)
    row = metrics.first()
    assert row.val_accuracy == 1.0 and row.val_f1_macro == 1.0
    assert (row.n_train, row.n_val, row.n_classes) == (72, 18, 3)
    store.save_model(model, str(tmp_path / "svm"))
    again = store.load_classifier(str(tmp_path / "svm"))
    got = classify.predict(again, df).collect()
    assert all(r.label == r.predicted for r in got)
    with pytest.raises(RuntimeError):
        classify.predict(None, df)


def test_rbf_features_separate_rings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):
        angle, radius = rng.uniform(0, 6.28), 1.0 if i % 2 else 4.0
        rows.append((i, [float(radius * np.cos(angle)), float(radius * np.sin(angle))], "in" if i % 2 else "out"))
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label string")
    lifted = classify.rbf_features(df, gamma=0.5, features=100)
    got = classify.predict(classify.train(lifted), lifted).collect()
    assert sum(r.label == r.predicted for r in got) / len(got) > 0.95


def test_nearest(spark):
    df = blobs(spark)
    centre = {r.id: r.predicted for r in classify.nearest_centroid(df, classify.centroids(df)).collect()}
    assert all(centre[r.id] == r.label for r in df.collect())
    near = classify.nearest_examples(df, df, 3, skip_self=True).collect()
    labels = {r.id: r.label for r in df.collect()}
    assert all(r.predicted == labels[r.id] and r.votes == 3 for r in near)
    far = classify.nearest_examples(df, df, 3, skip_self=True, min_score=2.0).first()
    assert far.predicted == "other"


def test_evaluate_answers(spark):
    df = spark.createDataFrame(
        [("m", "a", "a", 10.0, False), ("m", "a", "b", 20.0, False), ("m", "b", "b", 99.0, True)],
        "model string, label string, intent string, latency_ms double, failed boolean",
    )
    row = classify.evaluate_answers(df, failed="failed").first()
    assert row.accuracy == pytest.approx(1 / 3) and row.avg_inference_time_ms == pytest.approx(10.0)
    assert row.f1_macro == pytest.approx((2 / 3 + 0) / 2) and row.test_set_size == 3


def test_labels_and_predictions(spark, tmp_path):
    df = spark.createDataFrame([("q1", "b", "b"), ("q2", "a", "b")], "q string, t string, p string")
    coded = classify.encode_labels(df, "t")
    assert {r.t: r.label_index for r in coded.collect()} == {"a": 0, "b": 1}
    back = classify.decode_labels(coded.select("q", "label_index"), coded, "t")
    assert {r.q: r.t for r in back.collect()} == {"q1": "b", "q2": "a"}
    table = classify.prediction_table(df, "q", "t", "p")
    store.save_predictions(table, str(tmp_path / "p"))
    got = {r.question: r.is_correct for r in store.load_predictions(spark, str(tmp_path / "p")).collect()}
    assert got == {"q1": True, "q2": False}


def test_built_in_questions(spark):
    counts = {r.intent: r["count"] for r in classify.built_in_test_set(spark).groupBy("intent").count().collect()}
    assert counts == {"how_to": 8, "spec_query": 7, "diagnose": 8, "safety_check": 7}


def test_plugged_model_answers(spark):
    questions = spark.createDataFrame(
        [("how to reset", "how_to"), ("is it safe", "safety_check"), ("crash", "other"), (None, "other")],
        "question string, label string",
    ).withColumn("answer", F.lit("clash"))
    examples = spark.createDataFrame([(0, "e")], "pos int, text string")

    def make():
        calls = []

        def model(prompt):
            calls.append(prompt)
            if "crash" in prompt or len(calls) == 1:
                raise RuntimeError
            return "How_to." if "reset" in prompt else "I think safety_check"

        return model

    from tomelight.plans import jobs

    rows, metrics = jobs.few_shot(questions.coalesce(1), examples, make, retries=1)
    got = {r.question: (r.intent, r.failed) for r in rows.collect()}
    assert got["how to reset"] == ("how_to", False) and got["is it safe"] == ("safety_check", False)
    assert got["crash"][1] and got[None][1] and rows.filter("latency_ms < 0").isEmpty()
    result = metrics.first()
    assert result.test_set_size == 4 and result.accuracy == 1.0


@pytest.mark.parametrize("kernel", ["rbf", "linear"])
def test_text_to_label_job(spark, kernel):
    from tomelight.plans import jobs

    vectors = [(f"hot{i}", [1.0, 0.1 * i]) for i in range(5)] + [(f"cold{i}", [-1.0, 0.1 * i]) for i in range(5)]
    known = spark.createDataFrame(vectors, "word string, vector array<double>")
    rows = [(i, f"{'hot' if i % 2 else 'cold'}{i % 5} unknown word", "warm" if i % 2 else "chilly") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    model, metrics, table = jobs.train_text_classifier(df, known, kernel=kernel)
    assert metrics.first().val_accuracy == 1.0 and table.count() == 60 and table.filter("NOT is_correct").isEmpty()
    asked = spark.createDataFrame([(1, "hot1 hot2"), (2, "cold3")], "id long, text string")
    assert {r.id: r.predicted for r in model.predict(asked).collect()} == {1: "warm", 2: "chilly"}
    with pytest.raises(ValueError):
        jobs.train_text_classifier(df, known, kernel="poly")
