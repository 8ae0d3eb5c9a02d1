"""The batch plan over a folder that grows: files that arrive are booked once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.recompute import MONEY, line_base, tax

LINES = "payable long, quantity double, price double, disc_pct double, rate double, item_type string, total double"


def sums(lines: DataFrame) -> DataFrame:
    base = line_base(F.col("quantity"), F.col("price"), F.col("disc_pct"))
    rows = lines.withColumn("base", base).withColumn("tax", tax(F.col("base"), F.col("rate")))
    return rows.groupBy("payable").agg(F.sum(F.col("base").cast(MONEY)).cast(MONEY).alias("line_base"), F.sum(F.col("tax").cast(MONEY)).cast(MONEY).alias("line_tax"))


def book_new_lines(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the line sums of the files that are new since the last call; a payable's lines come in one file.

    A batch that is run again after a failure overwrites its own folder.
    """

    def write(batch: DataFrame, n: int) -> None:
        sums(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    lines = spark.readStream.schema(LINES).parquet(folder)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
