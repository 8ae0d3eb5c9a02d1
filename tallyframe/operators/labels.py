"""Values that labels point at, in rows (page, row_ix, text) read from the top."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.numbers import looks_like_amount, parse_amount
from tallyframe.functions.text import any_of, fold, label_in, text_after


def labelled_value(rows: DataFrame, labels: list[str], page: str = "page") -> DataFrame:
    """(page, value): what stands beside the first label, else in the next two rows unless they hold a label alone; as printed."""
    order = Window.partitionBy(page).orderBy("row_ix")
    below = F.when((F.trim("text") != "") & ~fold(F.col("text")).isin(labels), F.trim("text"))
    w = rows.withColumn("below", below).withColumn("label", label_in(fold(F.col("text")), labels))
    after = F.nullif(text_after(F.col("text"), F.col("label")), F.lit(""))
    w = w.withColumn("value", F.coalesce(after, F.lead("below", 1).over(order), F.lead("below", 2).over(order)))
    found = w.where("label IS NOT NULL AND value IS NOT NULL")
    return found.groupBy(page).agg(F.min_by("value", "row_ix").alias("value"))


def amounts(text):
    """The amounts among the words of a text, from left to right."""
    return F.filter(F.transform(F.filter(F.split(text, r"\s+"), looks_like_amount), parse_amount), lambda x: x.isNotNull())


def labelled_amount(rows: DataFrame, labels: list[str], page: str = "page", exclude: list[str] | None = None) -> DataFrame:
    """(page, amount): the last amount beside the longest label, of equals in the lowest row; only without any, the last amount of the row beneath the longest label, of equals the highest.

    Rows that contain one of ``exclude`` hold no label.
    """
    order = Window.partitionBy(page).orderBy("row_ix")
    last = lambda x: F.try_element_at(amounts(x), F.lit(-1))
    folded = fold(F.col("text"))
    label = label_in(folded, labels)
    label = F.when(~any_of(folded, exclude), label) if exclude else label
    w = rows.withColumn("beneath", F.lead(last(F.col("text"))).over(order)).withColumn("label", label).where("label IS NOT NULL")
    w = w.withColumn("beside", last(text_after(F.col("text"), F.col("label")))).withColumn("n", F.length("label"))
    beside = F.max_by("beside", F.when(F.col("beside").isNotNull(), F.struct("n", "row_ix")))
    under = F.max_by("beneath", F.when(F.col("beside").isNull() & F.col("beneath").isNotNull(), F.struct(F.col("n"), -F.col("row_ix"))))
    return w.groupBy(page).agg(F.coalesce(beside, under).alias("amount"))
