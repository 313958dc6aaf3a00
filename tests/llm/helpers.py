"""Small tables that every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000


def messy(spark, texts=()):
    """Nulls, empty, signs only, very long, ties, repeated rows, and extra columns that clash."""
    rows = [
        (1, None),
        (2, ""),
        (3, "!!! ???"),
        (4, "one"),
        (5, LONG),
        (6, LONG),
        (7, "a plain line of words\nsecond line of other words\n\n"),
        (7, "a plain line of words\nsecond line of other words\n\n"),
        (None, "a row without an id but with words"),
        *texts,
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("score", "key", "words", "next", "n_tokens", "class_id", "slot", "line", "_n", "n", "a", "b"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
