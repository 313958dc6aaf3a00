"""The map-only corpus build over arriving documents.

Cleaning, analysis and chunking keep no state between rows, so the batch
functions run unchanged on a streaming frame and need no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import chunking, corpus


def arriving_documents(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000
) -> DataFrame:
    """Parquet files as they land in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_corpus(
    arriving: DataFrame, path: str, checkpoint: str, chunks: bool = False, **trigger
) -> StreamingQuery:
    """Append processed documents (or their chunks) exactly once.

    ``arriving`` has doc_id, filename and raw_text. ``trigger`` is passed to the
    writer, ``availableNow=True`` by default.
    """
    out = corpus.build_corpus(arriving)
    if chunks:
        out = chunking.chunk(out)
    return (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
