"""Rows and tables from positioned words: words(page, word_ix, text, x0, x1, top, bottom)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import placing, reader
from tallyframe.sources.staging import bounded_batches


def row_clusters(words: DataFrame, page: str = "page") -> DataFrame:
    """words with row_ix: a new row starts where the middle lies further than max(0.6 of the upper median height, 2) below the last word's.

    A median height of 0 counts as 10. One shuffle by page; pages are the unit of work.
    """
    same = Window.partitionBy(page)
    w = words.withColumn("mid", (F.col("top") + F.col("bottom")) / 2).withColumn("height", F.col("bottom") - F.col("top"))
    middle = F.row_number().over(same.orderBy("height")) == F.floor(F.count("*").over(same) / 2) + 1
    w = w.withColumn("middle", middle).withColumn("upper", F.max(F.when(F.col("middle"), F.col("height"))).over(same))
    limit = F.greatest(0.6 * F.when(F.col("upper") == 0, 10.0).otherwise(F.col("upper")), F.lit(2.0))
    order = same.orderBy("mid", "x0", "word_ix")
    w = w.withColumn("starts", F.coalesce((F.col("mid") - F.lag("mid").over(order) > limit).cast("int"), F.lit(0)))
    return w.withColumn("row_ix", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("starts", "upper", "middle", "height")


def row_texts(words: DataFrame, page: str = "page") -> DataFrame:
    """(page, row_ix, text, n): the words of each row from left to right, joined by a space."""
    ordered = F.array_sort(F.collect_list(F.struct("x0", "word_ix", "text")))
    return words.groupBy(page, "row_ix").agg(ordered.alias("w")).select(page, "row_ix", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), F.size("w").alias("n"))


def column_bounds(heads: DataFrame, page: str = "page") -> DataFrame:
    """heads (page, kind, x0, x1) with left and right: midpoints to the neighbours, 0 and infinity at the ends."""
    order = Window.partitionBy(page).orderBy("x0", "kind")
    left = F.coalesce((F.lag("x1").over(order) + F.col("x0")) / 2, F.lit(0.0))
    right = F.coalesce((F.col("x1") + F.lead("x0").over(order)) / 2, F.lit(float("inf")))
    return heads.withColumn("left", left).withColumn("right", right)


def cells(words: DataFrame, bounds: DataFrame, page: str = "page") -> DataFrame:
    """(page, row_ix, kind, text): words in the column whose [left, right) holds their centre; others are dropped.

    The bounds of a page are one array, so the interval join is an equi join on the page.
    """
    sides = bounds.groupBy(page).agg(F.collect_list(F.struct("left", "right", "kind")).alias("b"))
    centre = (F.col("x0") + F.col("x1")) / 2
    placed = words.join(sides, page).withColumn("kind", F.get(F.filter("b", lambda x: (centre >= x["left"]) & (centre < x["right"])), 0)["kind"])
    ordered = F.array_sort(F.collect_list(F.struct("x0", "word_ix", "text")))
    return placed.where(F.col("kind").isNotNull()).groupBy(page, "row_ix", "kind").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))


def headed_cells(words: DataFrame, page: str = "page") -> DataFrame:
    """(page, row_ix, kind, text): ``cells`` of the rows below a page's first, whose words with a ``head`` (the kind, or null) head the columns.

    What ``row_clusters``, ``column_bounds`` and ``cells`` tell, in one pass (``placing``) after one shuffle, which deals a row for each run of words of a page.
    """
    bounded_batches(words.sparkSession)
    plain = words.select(page, F.col("word_ix").cast("long").alias("word_ix"), "text", *[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "top", "bottom")], F.col("head").cast("string").alias("head"))
    packed = T.StructType([plain.schema[page], *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in plain.schema if f.name != page]])
    placed = plain.mapInArrow(partial(reader.packed_batches, keys=1), packed).repartition(page).sortWithinPartitions(page)
    return placed.mapInArrow(placing.cell_batches, T.StructType([plain.schema[page], *placing.CELL]))


def anchors(row_words: DataFrame, phrases: list[tuple[str, str]], page: str = "page") -> DataFrame:
    """(page, row_ix, kind, x0, x1): column kinds whose folded phrase is one to three words of a row, the longest and leftmost first.

    phrases: (kind, phrase), kinds in order of preference. A kind is taken once a row, words that a longer phrase holds are not used again.
    """
    from tallyframe.functions.text import fold

    kinds = list(dict.fromkeys(k for k, _ in phrases))
    by: dict[str, list[str]] = {}
    for k, p in phrases:
        by.setdefault(p, []).append(k)
    known = F.create_map(*[x for p, ks in by.items() for x in (F.lit(p), F.array(*[F.struct(F.lit(kinds.index(k)).alias("preference"), F.lit(k).alias("kind")) for k in ks]))])
    order = Window.partitionBy(page, "row_ix").orderBy("x0", "word_ix")
    w = row_words.withColumn("at", F.row_number().over(order)).withColumn("f", F.btrim(fold(F.col("text")), F.lit(".:%()")))
    # the three lengths are looked up on the row of their first word, so the words are placed and sorted once
    w = w.select(page, "row_ix", "at", "x0", F.col("f").alias("f0"), F.col("x1").alias("e0"), *[F.lead(c, i).over(order).alias(f"{n}{i}") for i in (1, 2) for c, n in (("f", "f"), ("x1", "e"))])
    for n in (3, 2, 1):
        gram = F.trim(F.concat(*[x for i in range(n) for x in (F.col(f"f{i}"), F.lit(" "))]))
        w = w.withColumn(f"k{n}", F.try_element_at(known, gram))
    grams = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"e{n - 1}").alias("end"), F.col(f"k{n}").alias("kinds")) for n in (3, 2, 1)])
    hits = w.where(F.coalesce("k3", "k2", "k1").isNotNull()).select(page, "row_ix", "at", "x0", F.explode(grams).alias("g")).select(page, "row_ix", "at", "x0", "g.n", "g.end", F.explode("g.kinds").alias("k"))
    listed = hits.groupBy(page, "row_ix").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "at", "k.preference", "n", "k.kind", "x0", "end"))).alias("h"))
    empty = F.slice("h", F.lit(1), F.lit(0))
    free = lambda taken, x: ~F.exists(taken, lambda t: (t["kind"] == x["kind"]) | ((x["at"] < t["at"] + t["n"]) & (t["at"] < x["at"] + x["n"])))
    chosen = F.aggregate("h", empty, lambda taken, x: F.when(free(taken, x), F.concat(taken, F.array(x))).otherwise(taken))
    return listed.select(page, "row_ix", F.explode(chosen).alias("c")).select(page, "row_ix", "c.kind", "c.x0", F.col("c.end").alias("x1"))


def table_header(found: DataFrame, page: str = "page") -> DataFrame:
    """(page, row_ix): the first row whose anchors hold three kinds, or quantity and unit price, or description and total."""
    kinds = F.collect_set("kind")
    both = lambda a, b: F.array_contains("k", a) & F.array_contains("k", b)
    rows = found.groupBy(page, "row_ix").agg(kinds.alias("k")).where((F.size("k") >= 3) | both("quantity", "unit_price") | both("description", "total"))
    return rows.groupBy(page).agg(F.min("row_ix").alias("row_ix"))


def take_while(rows: DataFrame, stop, page: str = "page") -> DataFrame:
    """The rows of each page before the first for which ``stop`` holds."""
    order = Window.partitionBy(page).orderBy("row_ix").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__stopped", F.max(stop.cast("int")).over(order)).where("__stopped = 0").drop("__stopped")


def fold_continuations(rows: DataFrame, starts, page: str = "page") -> DataFrame:
    """(page, row_ix, text): rows for which ``starts`` holds, with the texts of the rows that follow up to the next one."""
    order = Window.partitionBy(page).orderBy("row_ix").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("__at", F.last(F.when(starts, F.col("row_ix")), ignorenulls=True).over(order)).where("__at IS NOT NULL")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_ix", "text"))), lambda x: x["text"]), " ")
    return own.groupBy(page, F.col("__at")).agg(text.alias("text"), F.count("*").alias("rows")).withColumnRenamed("__at", "row_ix")
