"""Invoice-like inputs derived from the order tables, in DataFrame form and as DuckDB SQL for the checks.

Orders stand for payables, line items for their lines. Which peculiarity an order has (a printed rounding, a
prepayment, a tax stated twice, ...) follows from its key, so every outcome of reconciliation occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.numbers import round2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r2(x: str) -> str:
    """DuckDB: a double rounded half up to cents by its decimal text, as a double."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,2)) AS DOUBLE)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payable, line (quantity, price, disc_pct, rate, item_type, total) of every line item."""
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_name")
    price = round2(F.col("l_extendedprice") / F.col("l_quantity"))
    case = F.pmod(F.col("l_orderkey"), F.lit(16))
    rate = F.when(case.isin(2, 9, 12), F.lit(None).cast("double")).when(case.isin(4, 5), F.lit(20.0)).otherwise(round2(F.col("l_tax") * 100))
    out = item.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("l_orderkey").alias("payable"),
        F.col("l_quantity").alias("quantity"),
        price.alias("price"),
        round2(F.col("l_discount") * 100).alias("disc_pct"),
        rate.alias("rate"),
        F.when((case == 7) & (F.col("l_linenumber") == 1), "TAX").otherwise("GOODS").alias("item_type"),
    )
    return out.withColumn("total", round2(F.col("quantity") * F.col("price")))


LINES_SQL = f"""
lines AS (
  SELECT *, {r2("quantity * price")} AS total FROM (
    SELECT l_orderkey AS payable, l_quantity AS quantity, {r2("l_extendedprice / l_quantity")} AS price, {r2("l_discount * 100")} AS disc_pct,
      CASE WHEN l_orderkey % 16 IN (2, 9, 12) THEN NULL WHEN l_orderkey % 16 IN (4, 5) THEN 20.0e0 ELSE {r2("l_tax * 100")} END AS rate,
      CASE WHEN l_orderkey % 16 = 7 AND l_linenumber = 1 THEN 'TAX' ELSE 'GOODS' END AS item_type
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey))"""
