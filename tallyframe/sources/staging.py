"""Tables between the steps of a plan that several later steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """df, written as Parquet under spark.checkpoint.dir and read again: later steps prune its columns, and start from files if an executor is lost.

    Where the setting is absent a local session gets a folder of its own; a cluster must set it.
    """
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", at)
    path = f"{at.rstrip('/')}/tallyframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds the bytes of an Arrow batch that goes to Python, where the session leaves them unbounded."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "-1", "-1b", str(2**31 - 1), str(2**63 - 1), "2147483647b", "256MB", str(256 << 20)):
        spark.conf.set(key, size)
