"""Queries of the scalar functions: values are printed in many styles from the order tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import dates, numbers, text
from tallyframe.plans.derived import table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderdate")


def parse_amount_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _orders(spark, sf_dir).withColumn("c", F.round(F.col("o_totalprice") * 100).cast("long"))
    whole, frac = F.expr("c div 100"), F.lpad((F.col("c") % 100).cast("string"), 2, "0")
    grouped = F.format_number(whole, 0)
    style = lambda sep, dec: F.concat(F.replace(grouped, F.lit(","), F.lit(sep)), F.lit(dec), frac)
    printed = F.element_at(F.array(style(".", ","), style(",", "."), style(" ", ","), F.concat(F.lit("("), style("'", "."), F.lit(")")), F.concat(whole.cast("string"), F.lit(","), frac, F.lit("-")), F.concat(F.lit("EUR "), style("", "."))), (F.pmod("k", F.lit(6)) + 1).cast("int"))
    return own.withColumn("printed", printed).select("k", "printed", numbers.parse_amount(F.col("printed")).alias("amount"))


def format_money_rate_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem")
    own = item.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("m"), F.max(F.round(F.col("l_discount") * 100, 2)).alias("r"), F.max("l_quantity").alias("q"))
    return own.select("l_orderkey", numbers.money_text(F.col("m")).alias("money"), numbers.rate_text((F.col("r") / 8).cast("decimal(28,6)")).alias("rate"), numbers.rate_text(F.col("q").cast("decimal(28,6)")).alias("quantity"), numbers.rate_key((F.col("r") / 8).cast("decimal(28,6)")).alias("key"))


def looks_like_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"[ \n]")).alias("w"))
    return docs.groupBy("doc_id").agg(F.count(F.when(numbers.looks_like_amount(F.col("w")), 1)).alias("amounts"), F.count("*").alias("words"))


def plain_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select("event_id", "value")
    printed = F.element_at(F.array(F.format_string("%.2f", "value"), F.concat(F.lit("€ "), F.format_string("%.2f", "value")), F.concat(F.format_string("%.2f", "value"), F.lit("%")), F.lit("n/a"), F.lit("1.0d"), F.lit("")), (F.pmod("event_id", F.lit(6)) + 1).cast("int"))
    return own.select("event_id", numbers.plain_number(printed).alias("number"))


_DATE_STYLES = ["yyyy-MM-dd", "dd.MM.yyyy", "d/M/yy", "d MMMM yyyy", "MMMM d, yyyy"]


def parse_date_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _orders(spark, sf_dir).withColumn("d", F.col("o_orderdate").cast("date")).withColumn("d", F.when(F.pmod("k", F.lit(5)) == 2, F.add_months("d", 120)).otherwise(F.col("d")))
    printed = F.element_at(F.array(*[F.date_format("d", s) for s in _DATE_STYLES]), (F.pmod("k", F.lit(5)) + 1).cast("int"))
    return own.withColumn("printed", F.concat(F.lit("Date: "), printed)).select("k", dates.parse_date(F.col("printed")).alias("date"))


_CURRENCY_CASES = ["Total EUR 5 USD", "Summe 12,50 €", "RM 7", "nothing here", "pay gbp or aud", "TERMS €", "R$ 3", "EURO"]
_CURRENCY_WANT = ["EUR", "EUR", "MYR", "", "AUD", "MYR", "BRL", "MYR"]


def detect_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.element_at(F.array(*[F.lit(x) for x in _CURRENCY_CASES[:7]]), (F.pmod("k", F.lit(7)) + 1).cast("int"))
    return _orders(spark, sf_dir).select("k", numbers.detect_currency(shown).alias("currency"))


def normalise_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return docs.select("doc_id", F.size("t").cast("long").alias("tokens"), F.size(F.array_distinct("t")).cast("long").alias("distinct_tokens"), F.length(F.array_join("t", " ")).cast("long").alias("letters"))


_IDENTIFIER_CASES = ["INV 000{k}; dated", "{k}: x", "no digits here", "RE. {k}", "Number {k}", "#{k},"]


def clean_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.element_at(F.array(*[F.replace(F.lit(c), F.lit("{k}"), F.col("k").cast("string")) for c in _IDENTIFIER_CASES]), (F.pmod("k", F.lit(6)) + 1).cast("int"))
    return _orders(spark, sf_dir).select("k", text.clean_identifier(shown).alias("identifier"))


def find_vat_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "supplier").select("s_suppkey")
    nine = F.lpad(F.col("s_suppkey").cast("string"), 9, "1")
    shown = F.concat(F.lit("Vat id de "), nine, F.lit(", DE"), nine, F.lit(" and AT"), nine, F.lit(" gha-vat-"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), F.lit(" IBAN DE89"), F.lpad(F.col("s_suppkey").cast("string"), 18, "0"), F.lit(" ap@x-"), F.col("s_suppkey").cast("string"), F.lit(".example.com"))
    return own.select("s_suppkey", F.array_join(text.vat_ids(shown), ",").alias("vat_ids"), F.array_join(text.ibans(shown), ",").alias("ibans"), text.email(shown).alias("email"))


_ITEM_CASES = [("Shipping and VAT", "FREIGHT"), ("VAT 20%", "TAX"), ("Customer support hours", "SERVICE"), ("Private widget", "GOODS"), ("a very long line that says tax somewhere", "GOODS"), ("Fräcträng", "GOODS")]


def classify_item_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    shown = F.element_at(F.array(*[F.lit(c) for c, _ in _ITEM_CASES]), (F.pmod("p_partkey", F.lit(6)) + 1).cast("int"))
    return part.select("p_partkey", text.item_type(shown).alias("item_type"))


_TREATMENT_CASES = [("Preise inkl. prices incl. VAT", True, "VAT"), ("plus VAT and GST", False, "GST"), ("IVA", None, "IVA"), ("withholding", None, "WHT"), ("NHIL levy", None, "LEVY"), ("SST", None, "SST")]


def tax_treatment(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.element_at(F.array(*[F.lit(c) for c, _, _ in _TREATMENT_CASES]), (F.pmod("k", F.lit(6)) + 1).cast("int"))
    return _orders(spark, sf_dir).select("k", text.prices_include_tax(shown).alias("inclusive"), text.tax_kind(shown).alias("kind"))


QUERIES = {f.__name__: f for f in (parse_amount_locales, format_money_rate_qty, looks_like_amount, plain_numbers, parse_date_styles, detect_currency, normalise_tokens, clean_identifier, find_vat_ids, classify_item_type, tax_treatment)}


def _case(column: str, values: list, n: int) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"
    return f"CASE {column} % {n} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


_DUCK_AMOUNT = r"^[\s(\-+]*[€$£¥₹₵₦₺₴₪]?\s*[0-9][0-9.,''\s\x{00a0}\x{202f}]*(?:[%]|[-)])?[\s.,;:]*$"
_TEN = "CASE WHEN strpos({0}, '.') > 0 THEN rtrim(rtrim({0}, '0'), '.') ELSE {0} END"
_RATE8 = "CAST(CAST(CAST(CAST(l_discount * 100 AS VARCHAR) AS DECIMAL(38,2)) AS DOUBLE) / 8 AS DECIMAL(28,6))"
ORACLE = {
    "parse_amount_locales": """SELECT k, CASE k % 6 WHEN 0 THEN replace(g, ',', '.') || ',' || f WHEN 1 THEN g || '.' || f WHEN 2 THEN replace(g, ',', ' ') || ',' || f
  WHEN 3 THEN '(' || replace(g, ',', '''') || '.' || f || ')' WHEN 4 THEN w || ',' || f || '-' ELSE 'EUR ' || replace(g, ',', '') || '.' || f END AS printed,
  CAST(CAST(CASE WHEN k % 6 IN (3, 4) THEN -c ELSE c END AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(9,6)) AS DECIMAL(28,6)) AS amount
FROM (SELECT k, c, format('{:,}', c // 100) AS g, CAST(c // 100 AS VARCHAR) AS w, lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS f FROM (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders))""",
    "format_money_rate_qty": f"""SELECT l_orderkey, CAST(m AS VARCHAR) AS money, {_TEN.format('CAST(r AS VARCHAR)')} AS rate, {_TEN.format('CAST(q AS VARCHAR)')} AS quantity,
  CAST(round_even(CAST(r AS DOUBLE), 2) AS DECIMAL(9,2)) AS key
FROM (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS m, max({_RATE8}) AS r, CAST(max(l_quantity) AS DECIMAL(28,6)) AS q FROM lineitem GROUP BY l_orderkey)""",
    "looks_like_amount": f"""SELECT doc_id, count(*) FILTER (length(trim(w)) > 0 AND regexp_matches(trim(w), '{_DUCK_AMOUNT}')) AS amounts, count(*) AS words
FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents) GROUP BY doc_id""",
    "plain_numbers": "SELECT event_id, CASE WHEN event_id % 6 < 3 THEN CAST(printf('%.2f', value) AS DOUBLE) ELSE 0.0e0 END AS number FROM events",
    "parse_date_styles": "SELECT o_orderkey AS k, CAST(CASE WHEN o_orderkey % 5 = 2 THEN CAST(o_orderdate AS DATE) + INTERVAL 120 MONTH ELSE CAST(o_orderdate AS DATE) END AS DATE) AS date FROM orders",
    "detect_currency": f"SELECT o_orderkey AS k, {_case('o_orderkey', _CURRENCY_WANT[:7], 7)} AS currency FROM orders",
    "normalise_tokens": """SELECT doc_id, CAST(len(t) AS BIGINT) AS tokens, CAST(len(list_distinct(t)) AS BIGINT) AS distinct_tokens, CAST(length(array_to_string(t, ' ')) AS BIGINT) AS letters
FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM documents)""",
    "clean_identifier": "SELECT k, CASE k % 6 WHEN 0 THEN 'INV 000' || k WHEN 1 THEN '' || k WHEN 2 THEN '' WHEN 3 THEN 'RE ' || k WHEN 4 THEN '' || k ELSE '' || k END AS identifier FROM (SELECT o_orderkey AS k FROM orders)",
    "find_vat_ids": """SELECT s_suppkey, 'DE' || n || ',AT' || n || ',GHA-VAT-' || lpad(k, 6, '0') AS vat_ids, 'DE89' || lpad(k, 18, '0') AS ibans, 'ap@x-' || k || '.example.com' AS email
FROM (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS k, lpad(CAST(s_suppkey AS VARCHAR), 9, '1') AS n FROM supplier)""",
    "classify_item_type": f"SELECT p_partkey, {_case('p_partkey', [w for _, w in _ITEM_CASES], 6)} AS item_type FROM part",
    "tax_treatment": f"SELECT o_orderkey AS k, {_case('o_orderkey', [w for _, w, _ in _TREATMENT_CASES], 6)} AS inclusive, {_case('o_orderkey', [w for _, _, w in _TREATMENT_CASES], 6)} AS kind FROM orders",
}
