"""Queries that score texts: language (1), quality (7) and toxicity (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import labelled, langid, mil, zstdtox
from tallyframe.llm.shared import table

#: Labelled documents that a model is fitted on, at most.
QUALITY_ROWS, TOXIC_ROWS = 10_000, 10_000
KEEP_QUALITY, CALL_TOXIC = 0.7, 0.3


def _result(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", labelled.fold_is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mil.fitted(labelled.sample(docs, table(spark, sf_dir, "labels"), "quality", QUALITY_ROWS))
    return _result(mil.score_quality(docs, model, attention=False), KEEP_QUALITY)


def op9_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = zstdtox.fitted(labelled.sample(docs, table(spark, sf_dir, "labels"), "toxic", TOXIC_ROWS))
    return _result(zstdtox.score_toxicity(docs, model), CALL_TOXIC)


QUERIES = {"op1_language_id": op1_language_id, "op7_mil_quality": op7_mil_quality, "op9_zstd_toxicity": op9_zstd_toxicity}
ORACLE: dict[str, str] = {}
