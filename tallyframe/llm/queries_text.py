"""Queries over whole texts: benchmark decontamination (2), suffix dedup (3), BPE (4), licence scans (6) and near duplicates (8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, dartminhash, decontaminate, licences, suffixdedup
from tallyframe.llm.shared import table


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.remaining(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.decode_ids(bpe.encode_texts(docs, path).select("doc_id", "ids"), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda p: p["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))).alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP2 = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[i : i + 12] AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT len(words) AS n FROM win),
cand AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM cand JOIN win USING (words)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

QUERIES = {"op2_decontaminate": op2_decontaminate, "op3_suffix_dedup": op3_suffix_dedup, "op4_bpe": op4_bpe, "op6_licence_scan": op6_licence_scan, "op8_dart_minhash": op8_dart_minhash}
ORACLE = {"op2_decontaminate": _OP2}
