"""Tables that cut lineage, in the folder that the cluster shares, and small session helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; a cluster must set it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        set_by_code = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = set_by_code.get() if set_by_code.isDefined() else None
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written as Parquet in the shared folder and read again: later work starts from replicated files, not from lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    released(spark)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps whose result is written: it acts when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds the bytes of an Arrow batch that goes to Python, where the session leaves them unbounded."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "-1", "-1b", str(2**31 - 1), str(2**63 - 1), "2147483647b", "256MB", str(256 << 20)):
        spark.conf.set(key, size)


def packed(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df as (__row, text): all columns but the text in one struct, so that no column's name can clash with a computed one."""
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    return df.select(F.struct(F.lit(0).alias("__"), *others).alias("__row"), F.col(f"`{text_col}`").alias("text"))


def unpacked(df: DataFrame, columns: list[str], text_col: str = "text", text: Column | None = None) -> DataFrame:
    """The columns that ``packed`` put away, in their order; ``text`` may be another expression."""
    text = F.col("text") if text is None else text
    return df.select(*[(text if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(schema) -> list[str]:
    return [f.name for f in schema.fields]
