"""Bounded samples of labelled texts for fitting, and the held-out fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import written


def fold_is_held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, bytes, int]]:
    """(id, text, label) of labelled documents outside the held-out fold, by a hash of the id: at most ``rows``, and of these,
    in that order, those that fit into ``most_bytes`` of text together.

    The driver holds them; an id that repeats in either table counts once. Null labels and ids are left out.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~fold_is_held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.min(label).cast("int").alias("label"))
    chosen = chosen.withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    found = written(texts.join(F.broadcast(chosen), "id").groupBy("id", "order", "label").agg(F.min("text").alias("text")), "sample")
    left, use = most_bytes, []
    for r in found.select("id", "order", F.octet_length("text").alias("n")).orderBy("order", "id").collect():
        if r.n <= left:
            left -= r.n
            use.append(r.id)
    got = found.where(F.col("id").isin(use)).select("id", "text", "label").toArrow()
    return sorted(zip(*(got.column(i).to_pylist() for i in range(3))))
