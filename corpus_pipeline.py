"""The corpus pipeline: from documents to packed training sequences.

Every stage works on all rows that its predecessor kept, as written and read again.
The first four return the columns of ``documents``; the last one row per piece of a
document with its place in a sequence.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomelight.llm import dartminhash, decontaminate, lines, packing, quality
from tomelight.sources.store import collecting, materialize, remove

#: Intermediate tables of stages that were called one by one and whose results have been written since.
pending: list[str] = []


def read_by(df: DataFrame, path: str) -> bool:
    """Whether a frame reads files below a path."""
    name = path.rsplit("/", 1)[-1]
    return any(f"/{name}/" in file for file in df.inputFiles())


def stage(work: Callable) -> Callable:
    """A stage that first removes the tables of the one before, unless its input still reads one of them.

    :func:`run` calls the undecorated function and removes the tables of its own stages only.
    """

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if pending and not any(read_by(docs, path) for path in pending):
            remove(spark, pending)
            pending.clear()
        with collecting() as made:
            out = work(spark, docs, sf_dir)
        pending.extend(made)
        return out

    return run_stage


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the usable labels, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones."""
    kept = lines.drop_repeated(docs, least=1).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return dartminhash.keep_one(docs)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the classifier nor the hashes; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, work in STAGES[:-1]:
        with collecting() as made:
            docs = materialize(work.__wrapped__(spark, docs, sf_dir))
        # The stage's result, written last, is all that is still read.
        remove(spark, [*before, *made[:-1]])
        before = made[-1:]
    return STAGES[-1][1].__wrapped__(spark, docs, sf_dir)
