"""Queries over words, rows and pages derived from texts, events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import labels, layout, segment
from tallyframe.plans.derived import table
from tallyframe.sources.staging import staged


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents with positions: 30 units a word, 12 a line, heights of 10, tops that wobble."""
    line = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("line", "t"))
    w = line.select("page", "line", F.posexplode(F.split("t", " ")).alias("ix", "text")).where("text <> ''")
    top = F.col("line") * 12.0 + (F.col("ix") % 3) * 0.5
    return w.select("page", "line", (F.col("line") * 100000 + F.col("ix")).alias("word_ix"), "text", (F.col("ix") * 30.0).alias("x0"), (F.col("ix") * 30.0 + 20.0).alias("x1"), top.alias("top"), (top + 10.0).alias("bottom"))


_WORDS = """w AS (SELECT page, line, ix, text, ix * 30.0e0 AS x0, ix * 30.0e0 + 20.0e0 AS x1 FROM (
  SELECT page, line, unnest(string_split(t, ' ')) AS text, unnest(range(len(string_split(t, ' ')))) AS ix FROM (
    SELECT doc_id AS page, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents)) WHERE text <> '')"""
_ROWS = f"{_WORDS}, r AS (SELECT page, line, dense_rank() OVER (PARTITION BY page ORDER BY line) - 1 AS row_ix, string_agg(text, ' ' ORDER BY ix) AS text, count(*) AS n FROM w GROUP BY page, line)"


def _rows(spark, sf_dir):
    return layout.row_texts(layout.row_clusters(words(spark, sf_dir)))


def row_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("page", "row_ix", F.md5("text").alias("text_md5"), F.col("n").cast("long").alias("n"))


def column_bounds_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words at 0, 3 and 7 of a page's first row head columns; the rest of the page falls into their bounds."""
    head = F.when(F.col("x0").isin(0.0, 90.0, 210.0), F.concat(F.lit("c"), (F.col("x0") / 30).cast("int").cast("string")))
    found = layout.headed_cells(words(spark, sf_dir).withColumn("head", head))
    return found.groupBy("page", "kind").agg(F.count("*").alias("cells"), F.sum(F.length("text")).alias("letters"))


_HEADS = [("description", "the"), ("description", "of the"), ("quantity", "and"), ("total", "de la"), ("total", "de"), ("tax", "the and")]


def column_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of whole texts in which column headings stand; ``header`` marks the row that heads a page's table."""
    found = staged(layout.anchors(layout.row_clusters(words(spark, sf_dir)), _HEADS), "anchors")
    rows = found.groupBy("page", "row_ix").agg(F.array_join(F.array_sort(F.collect_list("kind")), ",").alias("kinds"), F.min("x0").alias("x0"))
    heads = layout.table_header(found).withColumnRenamed("row_ix", "head")
    return rows.join(heads, "page", "left").select("page", "row_ix", "kinds", "x0", F.coalesce(F.col("row_ix") == F.col("head"), F.lit(False)).alias("header"))


def table_takewhile(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = layout.take_while(_rows(spark, sf_dir), F.col("text").rlike(r"(^|[^A-Za-z])(this|nicht|avec|para)([^A-Za-z]|$)"))
    return kept.groupBy("page").agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("letters"))


def continuation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = layout.fold_continuations(_rows(spark, sf_dir), F.length("text") > 40)
    return merged.select("page", "row_ix", F.md5("text").alias("text_md5"), "rows")


def _events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    amount = F.format_string("%.2f", "value")
    text = F.element_at(F.array(F.concat(F.lit("Total due: "), amount), F.lit("Amount due"), F.concat(F.lit("ref "), F.col("event_id").cast("string")), F.concat(F.lit("Due: "), amount), F.concat(F.lit("sum "), amount)), (F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(5)) + 1).cast("int"))
    return e.select(F.col("user_id").alias("page"), F.col("event_id").alias("row_ix"), text.alias("text"))


_LABELS = ["total due", "amount due", "due"]


def labelled_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.labelled_value(_events(spark, sf_dir), _LABELS)


def labelled_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.labelled_amount(_events(spark, sf_dir), _LABELS)


_EVENTS = """e AS (SELECT user_id AS page, event_id AS row_ix, (event_id * 7 + user_id) % 5 AS k, printf('%.2f', value) AS a FROM events),
t AS (SELECT *, CASE k WHEN 0 THEN 'Total due: ' || a WHEN 1 THEN 'Amount due' WHEN 2 THEN 'ref ' || row_ix WHEN 3 THEN 'Due: ' || a ELSE 'sum ' || a END AS text FROM e),
n AS (SELECT *, lead(text, 1) OVER o AS t1, lead(k, 1) OVER o AS k1, lead(text, 2) OVER o AS t2, lead(k, 2) OVER o AS k2, lead(a, 1) OVER o AS a1 FROM t WINDOW o AS (PARTITION BY page ORDER BY row_ix))"""


def _pages(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") * 5 + F.col("turn") * 3
    number = F.when(k % 4 == 0, F.concat(F.lit("n"), F.expr("turn div 3").cast("string"))).otherwise("")
    kind = F.element_at(F.array(F.lit("INVOICE"), F.lit(""), F.lit("STATEMENT"), F.lit(""), F.lit("INVOICE"), F.lit("RECEIPT"), F.lit("")), (F.pmod(k, F.lit(7)) + 1).cast("int"))
    index = F.when(k % 6 == 0, F.col("turn") % 3 + 1)
    return c.select(F.col("conv_id").alias("file"), F.col("turn").alias("page"), number.alias("number"), kind.alias("kind"), index.cast("int").alias("page_index"), F.when(index.isNotNull(), 3).alias("page_count"), (k % 11 == 0).alias("continued"), (k % 5 == 0).alias("credit"), (k % 2 == 0).alias("amount_due"), (k % 3 == 0).alias("tax_words"))


_PAGES = """p AS (SELECT conv_id AS file, turn AS page, CASE WHEN k % 4 = 0 THEN 'n' || (turn // 3) ELSE '' END AS number,
  ['INVOICE', '', 'STATEMENT', '', 'INVOICE', 'RECEIPT', ''][CAST(k % 7 + 1 AS INTEGER)] AS kind, CASE WHEN k % 6 = 0 THEN turn % 3 + 1 END AS pix, k % 11 = 0 AS continued, k % 5 = 0 AS credit, k % 2 = 0 AND k % 3 = 0 AS both_, k % 2 = 0 AS due, k % 3 = 0 AS taxed
  FROM (SELECT *, conv_id * 5 + turn * 3 AS k FROM conversations)),
b AS (SELECT *, last_value(CASE WHEN number <> '' OR kind <> '' THEN row(number, kind) END IGNORE NULLS) OVER (PARTITION BY file ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev, row_number() OVER (PARTITION BY file ORDER BY page) AS rn FROM p),
f AS (SELECT *, CASE WHEN rn = 1 THEN 1 WHEN coalesce(pix, 0) > 1 OR continued THEN 0 WHEN prev IS NULL THEN 1 WHEN number <> '' AND prev[1] <> '' AND number <> prev[1] THEN 1
  WHEN kind <> '' AND prev[2] <> '' AND kind <> prev[2] THEN 1 WHEN pix = 1 THEN 1 WHEN kind <> '' AND number = '' AND prev[1] = '' THEN 1 ELSE 0 END AS new FROM b),
s AS (SELECT *, CAST(sum(new) OVER (PARTITION BY file ORDER BY page) AS INTEGER) AS doc_ix FROM f),
d AS (SELECT file, doc_ix, count(*) AS pages, arg_min(kind, page) FILTER (kind <> '') AS title, bool_or(credit) AS credit, bool_or(due) AS due, bool_or(taxed) AS taxed FROM s GROUP BY file, doc_ix),
c AS (SELECT file, doc_ix, pages, CASE WHEN title = 'INVOICE' THEN CASE WHEN credit THEN 'CREDIT_NOTE' ELSE 'INVOICE' END WHEN title IS NOT NULL THEN title WHEN due AND taxed THEN CASE WHEN credit THEN 'CREDIT_NOTE' ELSE 'INVOICE' END ELSE 'OTHER' END AS kind FROM d)"""


def segment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.segment(_pages(spark, sf_dir)).select("file", "page", "doc_ix")


def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.classify(segment.segment(_pages(spark, sf_dir)))


def decline_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.declined(classify_documents(spark, sf_dir)).groupBy("kind", "reason").agg(F.count("*").alias("documents"))


def ocr_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with little text are read again and replaced where a second reading exists."""
    from tallyframe.sources import readers

    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("page"), "text")
    again = pages.where("page % 2 = 0").select("file", "page", F.concat(F.lit("again "), "text").alias("text"))
    return readers.second_reading(pages, again, least=200).select("file", "page", "source", F.length("text").alias("letters"))


_CUES = {"eng": [" the ", " of ", " and "], "deu": [" der ", " und ", " ein "], "fra": [" le ", " de ", " et "], "spa": [" el ", " que ", " de "]}


def language_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.sources import readers

    return table(spark, sf_dir, "documents").select("doc_id", readers.guess_language(F.lower("text"), _CUES).alias("language"))


QUERIES = {f.__name__: f for f in (row_clusters, column_bounds_cells, column_anchors, table_takewhile, continuation_merge, labelled_value, labelled_amount, segment_documents, classify_documents, decline_routing, ocr_routing, language_guess)}
_STRIP = "trim({0}, ' .-–—')"
ORACLE = {
    "row_clusters": f"WITH {_ROWS} SELECT page, CAST(row_ix AS INTEGER) AS row_ix, md5(text) AS text_md5, n FROM r",
    "column_bounds_cells": f"""WITH {_WORDS}, x AS (SELECT *, dense_rank() OVER (PARTITION BY page ORDER BY line) - 1 AS row_ix FROM w),
h AS (SELECT page, 'c' || CAST(x0 / 30 AS INTEGER) AS kind, coalesce((lag(x1) OVER o + x0) / 2, 0.0e0) AS lo, coalesce((x1 + lead(x0) OVER o) / 2, 1e18) AS hi FROM x WHERE row_ix = 0 AND x0 IN (0.0, 90.0, 210.0) WINDOW o AS (PARTITION BY page ORDER BY x0)),
c AS (SELECT x.page, row_ix, kind, string_agg(text, ' ' ORDER BY ix) AS text FROM x JOIN h ON x.page = h.page AND row_ix > 0 AND (x0 + x1) / 2 >= lo AND (x0 + x1) / 2 < hi GROUP BY x.page, row_ix, kind)
SELECT page, kind, count(*) AS cells, CAST(sum(length(text)) AS BIGINT) AS letters FROM c GROUP BY page, kind""",
    "table_takewhile": f"""WITH {_ROWS}, s AS (SELECT *, max(CAST(regexp_matches(text, '(^|[^A-Za-z])(this|nicht|avec|para)([^A-Za-z]|$)') AS INTEGER)) OVER (PARTITION BY page ORDER BY row_ix) AS stopped FROM r)
SELECT page, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS letters FROM s WHERE stopped = 0 GROUP BY page""",
    "continuation_merge": f"""WITH {_ROWS}, s AS (SELECT *, last_value(CASE WHEN length(text) > 40 THEN row_ix END IGNORE NULLS) OVER (PARTITION BY page ORDER BY row_ix) AS head FROM r)
SELECT page, CAST(head AS INTEGER) AS row_ix, md5(string_agg(text, ' ' ORDER BY row_ix)) AS text_md5, count(*) AS rows FROM s WHERE head IS NOT NULL GROUP BY page, head""",
    "labelled_value": f"""WITH {_EVENTS}, v AS (SELECT page, row_ix, CASE WHEN k IN (0, 3) THEN a WHEN k1 <> 1 THEN t1 WHEN k2 <> 1 THEN t2 END AS value FROM n WHERE k IN (0, 1, 3))
SELECT page, arg_min(value, row_ix) AS value FROM v WHERE value IS NOT NULL GROUP BY page""",
    "labelled_amount": f"""WITH {_EVENTS}, v AS (SELECT page, row_ix, CASE k WHEN 0 THEN 9 WHEN 3 THEN 3 ELSE 10 END AS len, CASE WHEN k IN (0, 3) THEN CAST(a AS DECIMAL(28,6)) END AS beside,
  CASE WHEN k = 1 THEN CASE WHEN k1 = 2 THEN CAST(row_ix1 AS DECIMAL(28,6)) WHEN k1 IN (0, 3, 4) THEN CAST(a1 AS DECIMAL(28,6)) END END AS beneath FROM (SELECT *, lead(row_ix) OVER (PARTITION BY page ORDER BY row_ix) AS row_ix1 FROM n) WHERE k IN (0, 1, 3))
SELECT page, coalesce(arg_max(beside, row(len, row_ix)) FILTER (beside IS NOT NULL), arg_max(beneath, row(len, -row_ix)) FILTER (beneath IS NOT NULL)) AS amount FROM v GROUP BY page""",
    "segment_documents": f"WITH {_PAGES} SELECT file, page, doc_ix FROM s",
    "classify_documents": f"WITH {_PAGES} SELECT file, doc_ix, pages, kind FROM c",
    "decline_routing": f"WITH {_PAGES} SELECT kind, CASE kind WHEN 'STATEMENT' THEN 'lists other documents' WHEN 'RECEIPT' THEN 'a payment already made' ELSE 'nothing to pay' END AS reason, count(*) AS documents FROM c WHERE kind NOT IN ('INVOICE', 'CREDIT_NOTE') GROUP BY kind",
    "ocr_routing": """SELECT conv_id AS file, turn AS page, CASE WHEN length(trim(text)) < 200 AND turn % 2 = 0 THEN 'ocr' ELSE 'text' END AS source,
  CAST(length(text) + CASE WHEN length(trim(text)) < 200 AND turn % 2 = 0 THEN 6 ELSE 0 END AS INTEGER) AS letters FROM conversations""",
    "language_guess": "WITH n AS (SELECT doc_id, "
    + ", ".join(f"{' + '.join(f'CAST(contains(lower(text), {chr(39)}{c}{chr(39)}) AS INTEGER)' for c in cues)} AS {lang}" for lang, cues in _CUES.items())
    + " FROM documents) SELECT doc_id, CASE WHEN greatest(eng, deu, fra, spa) < 2 THEN 'eng' WHEN eng = greatest(eng, deu, fra, spa) THEN 'eng' WHEN deu = greatest(eng, deu, fra, spa) THEN 'deu' WHEN fra = greatest(eng, deu, fra, spa) THEN 'fra' ELSE 'spa' END AS language FROM n",
}
