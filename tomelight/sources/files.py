"""Input files: document binaries, web pages, labelled JSON, word vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

LABELLED = "text string, label string"


def list_files(spark: SparkSession, directory: str, suffix: str = ".pdf") -> DataFrame:
    """Files of one directory by case-sensitive suffix: path, filename, content."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .load(directory)
    )
    return found.select(
        "path", F.substring_index("path", "/", -1).alias("filename"), "content"
    )


def decode_files(df: DataFrame, extractor: Callable[[bytes], str]) -> DataFrame:
    """Decode each file's bytes: filename, raw_text, error (null where decoding went well).

    ``extractor`` decodes one file. A file that fails has the text ``""``.
    """

    def decode(content: bytes) -> tuple[str, str | None]:
        try:
            return extractor(content) or "", None
        except Exception as error:
            return "", f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [decode(c) for c in batch["content"]]
            yield pd.DataFrame(
                {
                    "filename": batch["filename"],
                    "raw_text": [text for text, _ in found],
                    "error": pd.Series([error for _, error in found], index=batch.index, dtype=object),
                }
            )

    schema = "filename string, raw_text string, error string"
    return df.select("filename", "content").mapInPandas(run, schema)


def extract_text(df: DataFrame, extractor: Callable[[bytes], str]) -> DataFrame:
    """The texts of :func:`decode_files`; a file that fails or is empty is left out."""
    return decode_files(df, extractor).filter("raw_text <> ''").select("filename", "raw_text")


# The character entities decoded, in order.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}


def html_text(html: Column) -> Column:
    """Visible text of a page: comments, scripts, styles and tags removed."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<script[^>]*>.*?</script>", " ")
    out = F.regexp_replace(out, r"(?is)<style[^>]*>.*?</style>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return tx.strip(tx.squeeze(out))


def page_texts(df: DataFrame, html: str = "html", filename: str = "url") -> DataFrame:
    """The same job over a table of web pages, in columns alone."""
    texts = df.withColumn("raw_text", F.coalesce(html_text(F.col(html)), F.lit("")))
    return texts.withColumnRenamed(filename, "filename").drop(html).filter("raw_text <> ''")


def read_labelled(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """{text, label} objects: JSON arrays, or with ``multi_line=False`` one object per line."""
    return spark.read.schema(LABELLED).option("multiLine", multi_line).json(path)


def read_word_vectors(spark: SparkSession, path: str, dim: int = 100) -> DataFrame:
    """Text vectors, one ``word x1 x2 ...`` per line; malformed lines are left out."""
    parts = F.split("value", " ")
    numbers = F.transform(F.slice(parts, 2, dim), lambda x: x.try_cast("double"))
    return (
        spark.read.text(path)
        .filter(F.size(parts) == dim + 1)
        .select(F.get(parts, F.lit(0)).alias("word"), numbers.alias("vector"))
        .filter((F.col("word") != "") & ~F.exists("vector", lambda x: x.isNull()))
        .withColumn("vector", F.col("vector").cast("array<float>"))
    )
