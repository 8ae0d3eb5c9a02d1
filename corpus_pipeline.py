"""The corpus pipeline: quality, near duplicates, repeated passages, contamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, dartminhash, decontaminate, labelled, mil, suffixdedup
from tallyframe.llm.queries_scores import KEEP_QUALITY, QUALITY_ROWS
from tallyframe.llm.queries_text import tokenizer_path
from tallyframe.llm.shared import packed, table, unpacked, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores ``KEEP_QUALITY`` or more; it learns from labels outside the held-out fold."""
    model = mil.fitted(labelled.sample(docs, table(spark, sf_dir, "labels"), "quality", QUALITY_ROWS))
    return unpacked(mil.score_quality(packed(docs), model, attention=False).where(F.col("score") >= KEEP_QUALITY), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of equal or near texts."""
    return dartminhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes that a 100-byte string covers which also starts earlier; n_chars follows the text."""
    found = suffixdedup.dedup(docs)
    return found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that windows of benchmark items don't cover to a twentieth, neither as they are nor as they came in.

    The stage before may have cut the windows that a document is known by, so the documents of ``sf_dir`` are judged too.
    """
    benchmark, before = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    named = [c for c in ("doc_id", "lang", "source") if c in before.columns and c in docs.columns]
    return decontaminate.clean_before(decontaminate.decontaminate(docs, benchmark), before, benchmark, named)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Each document's token ids, and the text that they decode to."""
    path = path or tokenizer_path()
    kept = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip(kept, path, surface=False).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("contamination", contamination),
    ("tokens", tokens),
]

#: Models, signatures and merges are not SQL; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
