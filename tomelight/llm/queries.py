"""Registered queries of the training-data operators, over the whole given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    chat,
    dartminhash,
    decontaminate,
    licenses,
    lines,
    maxsketch,
    packing,
    quality,
    simhash,
    syncmers,
    token_files,
    warc,
)

TOKENIZER = "word_bpe_49k.json"
#: The two tokenizers that are aligned.
PAIR = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf, "documents"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op3_chat(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["begin"], s["end"]))
    return chat.rotate(table(spark, sf, "conversations")).withColumn("spans", F.array_join(spans, ","))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf, "documents"))


def op6_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.stored_documents(
        table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER)
    ).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_dartminhash(spark: SparkSession, sf: str) -> DataFrame:
    return dartminhash.classes(table(spark, sf, "documents"))


def op8_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.drop_repeated(table(spark, sf, "documents"), least=1).select("doc_id", "text", "n_lines", "n_dropped")


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in PAIR)
    return alignment.align_documents(table(spark, sf, "documents"), a, b)


def op12_maxsketch(spark: SparkSession, sf: str) -> DataFrame:
    return maxsketch.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf, "documents"))


def queries() -> dict:
    found = [
        op1_fingerprints,
        op2_packing,
        op3_chat,
        op4_quality,
        op5_licenses,
        op6_token_files,
        op7_dartminhash,
        op8_lines,
        op9_warc,
        op10_decontaminate,
        op11_alignment,
        op12_maxsketch,
        op13_simhash,
    ]
    return {query.__name__: query for query in found}


WARC_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), k AS (
    SELECT page_id, n, sha256(html) AS digest FROM p
), f AS (
    SELECT digest, min(page_id) AS first_id FROM k WHERE n >= 100 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, k.digest AS payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to, true AS intact
FROM k LEFT JOIN f ON k.digest = f.digest AND k.n >= 100
"""


CHAT_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(regexp_replace(role, '[\s<|>]+', '_', 'g'), 'unknown') AS role,
           regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') AS text,
           CAST(coalesce(floor(turn / 64), -1) AS BIGINT) AS part
    FROM conversations
), n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM t
), s AS (
    SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), r AS (
    SELECT n.*, speaker, role = speaker AS target,
           '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant'
                                  ELSE 'user name=' || role END || chr(10) AS head
    FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id
), p AS (
    SELECT *, coalesce(sum(length(head) + length(text) + 11) OVER (
               PARTITION BY conv_id, speaker, part ORDER BY rn
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS b
    FROM r
), g AS (
    SELECT conv_id, speaker, part,
           string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY rn) AS text,
           count(*) FILTER (WHERE target) AS n_targets,
           coalesce(string_agg(b::BIGINT || '-' || (b + length(text))::BIGINT, ',' ORDER BY rn)
                    FILTER (WHERE target), '') AS spans
    FROM p GROUP BY conv_id, speaker, part
)
SELECT conv_id, speaker, part,
       CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, speaker ORDER BY part
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       text, n_targets, spans
FROM g
"""


RANKED_SQL = r"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), f AS (
    SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term
), d AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id
), s AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM f, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs
), r AS (
    SELECT item_id, f.doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (doc_id), s GROUP BY item_id, f.doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": CHAT_SQL, "op9_warc": WARC_SQL, "op12_maxsketch": RANKED_SQL}
