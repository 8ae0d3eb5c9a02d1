"""Queries by DataFrame functions alone: sharding (5) and document fingerprints (10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import kdshard, spotsigs
from tallyframe.llm.shared import table


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdshard.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint_text(F.col("signs")).alias("fingerprint"),
        spotsigs.fingerprint_text(F.col("edited_signs")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        spotsigs.likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )


QUERIES = {"op5_kd_shards": op5_kd_shards, "op10_spotsigs": op10_spotsigs}
ORACLE: dict[str, str] = {}
