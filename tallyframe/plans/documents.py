"""Queries of line, tax, party, title and record parsing over texts printed from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import document, parse, record
from tallyframe.plans.derived import LINES_SQL, lines, table


def _keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))


def _pick(values, key="k"):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


_TAX_CELLS = [("19%", 19, None), ("7,5 %", 7.5, None), ("20", 20, None), ("123,45", None, 123.45), ("n/a", None, None), ("", None, None)]
_DISCOUNT_CELLS = [("5%", 5, None), ("12,00", None, 12), ("-3.50", None, 3.5), ("0", None, None), ("x", None, None), ("", None, None)]


def tax_discount_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _keys(spark, sf_dir).withColumn("t", parse.tax_cell(_pick([c for c, _, _ in _TAX_CELLS]))).withColumn("d", parse.discount_cell(_pick([c for c, _, _ in _DISCOUNT_CELLS])))
    return own.select("k", F.col("t.rate").alias("rate"), F.col("t.amount").alias("amount"), F.col("d.percentage").alias("percentage"), F.col("d.amount").alias("discount"))


def fill_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, k = F.lit(None).cast(parse.AMOUNT), F.col("k")
    total = F.when(k % 4 != 3, (k % 100 + 1).cast(parse.AMOUNT))
    price = F.when(k % 4 == 1, total).otherwise(none)
    row = F.when(k % 4 == 0, F.concat(F.lit("Widget 3 x "), (k % 50 + 1).cast("string"), F.lit(",50"))).otherwise(F.lit("Widget"))
    own = _keys(spark, sf_dir).withColumn("f", parse.filled(none, price, total, row)).withColumn("uom", parse.unit(_pick(["pcs", "12", "", None]), _pick(["5", "3 kg", "2 boxes,", "7"])))
    return own.select("k", "f.quantity", "f.price", "uom")


def _text_rows(spark, sf_dir):
    """Four rows a payable: a line, a tax, a registration and the same tax again."""
    own = _keys(spark, sf_dir)
    amount = F.concat((F.col("k") % 900 + 10).cast("string"), F.lit(",00"))
    rows = F.array(F.concat(F.lit("Blue widget "), amount), F.concat(F.lit("VAT 19% "), amount), F.lit("VAT ID: DE209177122"), F.concat(F.lit("VAT 19% "), amount), F.concat(F.lit("Withholding tax "), amount))
    return own.select(F.col("k").alias("page"), F.posexplode(rows).alias("row_ix", "text"))


def header_tax_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.header_taxes(_text_rows(spark, sf_dir), ["vat", "tax"], ["vat id", "subtotal"], ["withholding"])


def headerless_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.headerless_lines(_text_rows(spark, sf_dir)).groupBy("page").agg(F.count("*").alias("lines"), F.sum("total").cast("decimal(38,6)").alias("total"), F.min("description").alias("first"))


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _keys(spark, sf_dir).where("k IS NOT NULL")
    name = F.concat(F.lit("Nordwind "), F.col("k").cast("string"), F.lit(" GmbH"))
    rows = F.array(F.lit("INVOICE"), F.when(F.col("k") % 3 == 0, F.lit("Plain words here")).otherwise(name), F.lit("Street 5"), F.lit("Berlin, DE"), F.lit("Bill to:"), F.concat(F.lit("Buyer "), F.col("k").cast("string")), F.lit(""), F.lit("Road 9"), F.lit("Riga"))
    pages = own.select(F.col("k").alias("page"), F.posexplode(rows).alias("row_ix", "text"))
    return document.parties(pages)


_POSITIONS = [("Page 2 of 5", 2, 5), ("Seite 1 / 3", 1, 3), ("page total 4/9", 4, 9), ("see 4/9", None, None), ("page 9/4", 9, 4), ("página 3 de 7", 3, 7)]
_TITLED = [("TAX INVOICE 7 receipt", "INVOICE"), ("Receipt for invoice", "RECEIPT"), ("nothing", ""), ("dear sir, your statement of account", "STATEMENT"), ("Gutschrift", "CREDIT_NOTE"), ("Mahnung zur Rechnung", "REMINDER")]
_COUNTRIES = [("GHA-VAT-1", "", "", "GH"), ("de123", "x", "EUR", "DE"), ("", "Main st, MY", "", "MY"), ("", "Tallinn EE", "", "EE"), ("", "x", "NGN", "NG"), ("12", None, "EUR", "")]


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _keys(spark, sf_dir)
    place = parse.page_position(_pick([t for t, _, _ in _POSITIONS]))
    where = parse.country(*[_pick([c[i] for c in _COUNTRIES]) for i in range(3)])
    text = _pick([t for t, _ in _TITLED])
    return own.withColumn("p", place).select("k", F.col("p.index").alias("page_index"), F.col("p.count").alias("page_count"), parse.title_kind(text, text).alias("kind"), where.alias("country"))


def payable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's record, as counts and sums of its text leaves."""
    heads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("payable"), F.when(F.col("o_orderkey") % 5 == 0, "CREDIT_NOTE").otherwise("INVOICE").alias("kind"), F.col("o_orderkey").cast("string").alias("number"), F.lit("EUR").alias("currency"), F.when(F.col("o_orderkey") % 7 != 0, -F.col("o_totalprice")).alias("gross"), F.lit(None).cast("double").alias("subtotal"))
    items = lines(spark, sf_dir).select("payable", F.lit(" item ").alias("description"), "quantity", F.col("price").alias("unit_price"), "total", F.col("rate").alias("tax_rate"), F.lit(None).cast("double").alias("tax_amount"))
    made = record.payables(heads, items)
    return made.select("payable", "record.document_type", "record.gross_amount", F.size("record.line_items").alias("lines"), F.aggregate("record.line_items", F.lit(0), lambda n, x: n + F.size(x["taxes"])).alias("taxes"), F.aggregate("record.line_items", F.lit(0).cast("decimal(38,2)"), lambda s, x: (s + x["total"].cast("decimal(18,2)")).cast("decimal(38,2)")).alias("total"))


QUERIES = {f.__name__: f for f in (tax_discount_cells, fill_components, header_tax_rows, headerless_lines, parties, page_titles, payable_records)}


def _case(values, kind="DECIMAL(28,6)"):
    lit = lambda v: "NULL" if v is None else f"CAST('{v}' AS {kind})"
    return f"CASE k % {len(values)} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


_K = "FROM (SELECT o_orderkey AS k FROM orders)"
_A = "CAST(k % 900 + 10 AS DECIMAL(28,6))"
ORACLE = {
    "tax_discount_cells": f"SELECT k, {_case([r for _, r, _ in _TAX_CELLS])} AS rate, {_case([a for _, _, a in _TAX_CELLS])} AS amount, {_case([p for _, p, _ in _DISCOUNT_CELLS])} AS percentage, {_case([a for _, _, a in _DISCOUNT_CELLS])} AS discount {_K}",
    "fill_components": f"""SELECT k, CAST(CASE k % 4 WHEN 0 THEN 3 WHEN 3 THEN NULL ELSE 1 END AS DECIMAL(28,6)) AS quantity,
  CAST(CASE k % 4 WHEN 0 THEN k % 50 + 1.5 WHEN 3 THEN NULL ELSE k % 100 + 1 END AS DECIMAL(28,6)) AS price, CASE k % 4 WHEN 0 THEN 'pcs' WHEN 1 THEN 'kg' WHEN 2 THEN 'boxes' ELSE '' END AS uom {_K}""",
    "header_tax_rows": f"""SELECT k AS page, CAST(1 AS INTEGER) AS row_ix, 'VAT 19%' AS name, CAST(19 AS DECIMAL(28,6)) AS rate, CASE WHEN k % 900 + 10 <> 19 THEN {_A} END AS amount, 'VAT' AS kind {_K}
UNION ALL SELECT k, 4, 'Withholding tax', NULL, -{_A}, 'WHT' {_K}""",
    "headerless_lines": f"SELECT k AS page, CAST(4 AS BIGINT) AS lines, CAST(4 * {_A} AS DECIMAL(38,6)) AS total, 'Blue widget' AS first {_K}",
    "parties": f"""SELECT k AS page, CASE WHEN k % 3 = 0 THEN 'Plain words here' ELSE 'Nordwind ' || k || ' GmbH' END AS name, 'Street 5, Berlin, DE' AS address, 'Buyer ' || k AS buyer, 'Road 9, Riga' AS buyer_address {_K}""",
    "page_titles": f"SELECT k, {_case([i for _, i, _ in _POSITIONS], 'INTEGER')} AS page_index, {_case([n for _, _, n in _POSITIONS], 'INTEGER')} AS page_count, {_case([v for _, v in _TITLED], 'VARCHAR')} AS kind, {_case([c[3] for c in _COUNTRIES], 'VARCHAR')} AS country {_K}",
    "payable_records": f"""WITH {LINES_SQL}, s AS (SELECT payable, count(*) AS n, count(rate) AS t, sum(CAST(total AS DECIMAL(18,2))) AS total FROM lines GROUP BY payable)
SELECT o_orderkey AS payable, CASE WHEN o_orderkey % 5 = 0 THEN 'CREDIT_MEMO' ELSE 'INVOICE' END AS document_type, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,2)) AS VARCHAR) END AS gross_amount,
  CAST(coalesce(n, 0) AS INTEGER) AS lines, CAST(coalesce(t, 0) AS INTEGER) AS taxes, CAST(coalesce(total, 0) AS DECIMAL(38,2)) AS total FROM orders LEFT JOIN s ON o_orderkey = payable""",
}
