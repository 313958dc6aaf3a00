"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark import SparkConf
from pyspark.sql import SparkSession

from tomelight import registry

HEADLINE = [
    "b10_corpus",
    "b11_corpus_stats",
    "b13_top_lemmas",
    "c1_vocabulary",
    "c4_tfidf",
    "c8_similarity_edges",
    "c9_similar_docs",
    "d2_word2vec",
    "d3_subwords",
    "d7_similar_words",
    "d8_doc_means",
    "e1_encode",
    "e8_similar_by_model",
    "f7_chunks",
    "f9_chunk_table",
    "c11_retrieval_tfidf",
    "g2_dense",
    "g3_lexical",
    "g4_hybrid",
    "g6_results",
    "g12_retrieval_metrics",
    "h7_nearest_examples",
    "h5_h6_train_predict",
    "i1_summarize_single",
    "i2_summarize_hierarchical",
    "i4_rouge_n",
    "i6_greedy_match",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", os.path.abspath("spark-warehouse/bench"))
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registry.queries()
    # Start the JVM, the code generator and a Python worker before timing.
    warm = spark.range(1000).mapInArrow(lambda batches: batches, "id long")
    warm.write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        found[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
