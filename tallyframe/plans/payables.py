"""Queries of the recompute, reconciliation and reports, over orders as payables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.operators import recompute, reconcile, report
from tallyframe.operators.recompute import MONEY, line_base, tax
from tallyframe.plans.derived import LINES_SQL, lines, r2, table


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header a payable; what is printed on it follows from its key."""
    rows = lines(spark, sf_dir)
    base = line_base(F.col("quantity"), F.col("price"), F.col("disc_pct"))
    net_price = F.bround((F.col("price").cast("decimal(28,10)") / F.lit(1.2).cast("decimal(28,10)")).cast("decimal(28,10)"), 4).cast("double")
    net_base = line_base(F.col("quantity"), net_price, F.col("disc_pct"))
    rows = rows.withColumn("b", base).withColumn("t", tax(F.col("b"), F.col("rate"))).withColumn("nb", net_base).withColumn("nt", tax(F.col("nb"), F.lit(20.0)))
    total = lambda c, keep=None: F.sum((F.col(c) if keep is None else F.when(keep, F.col(c))).cast(MONEY)).cast(MONEY)
    goods = F.col("item_type") != "TAX"
    sums = rows.groupBy("payable").agg(total("b").alias("b"), total("t").alias("t"), total("nb").alias("nb"), total("nt").alias("nt"), total("b", goods).alias("gb"), total("t", goods).alias("gt"))
    own = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("payable")).join(sums, "payable", "left")
    for c in ("b", "t", "nb", "nt", "gb", "gt"):
        own = own.withColumn(c, F.coalesce(c, F.lit(0).cast(MONEY)))
    own = own.withColumn("k", F.pmod("payable", F.lit(16)))
    case = lambda **v: F.coalesce(*[F.when(F.col("k").isin(*[int(n) for n in name[1:].split("_")]), x) for name, x in v.items()])
    share = lambda pct: F.round(F.col("b").cast("double") * pct / 100.0, 2)
    cents = (F.pmod("payable", F.lit(5)) + 1) / F.lit(100.0)
    as_money = lambda x: x.cast(MONEY)
    own = (
        own.withColumn("header_rate", case(_2_12=F.lit(19.0), _4=F.lit(20.0)))
        .withColumn("header_amount", case(_3=F.col("t").cast("double"), _8=share(10.0)))
        .withColumn("discount", case(_6=F.lit(50.0)))
        .withColumn("charges", F.lit(None).cast("double"))
        .withColumn("printed_rounding", case(_1=cents, _9=F.lit(0.03)))
        .withColumn("printed_prepayment", case(_2=F.lit(100.0), _9=F.lit(40.0)))
        .withColumn("says_inclusive", F.col("k") == 5)
    )
    b, t = F.col("b"), F.col("t")
    stated = (
        F.when(F.col("k") == 1, b + t + as_money(cents))
        .when(F.col("k") == 2, b + as_money(share(19.0)) - as_money(F.lit(100)))
        .when(F.col("k") == 4, b + as_money(share(20.0)))
        .when(F.col("k") == 5, F.col("nb") + F.col("nt"))
        .when(F.col("k") == 7, F.col("gb") + F.col("gt"))
        .when(F.col("k") == 8, b + t - as_money(F.col("header_amount")))
        .when(F.col("k") == 9, b + as_money(F.lit(0.03)) - as_money(F.lit(40)))
        .when(F.col("k") == 10, b + t + as_money(F.lit(7.77)))
        .when(F.col("k") == 11, F.lit(None).cast(MONEY))
        .when(F.col("k") == 12, b + as_money(share(19.0)))
        .otherwise(b + t)
    )
    own = own.withColumn("stated", as_money(stated))
    own = own.withColumn("printed_subtotal", F.when(F.col("k") == 8, F.col("stated") + 1))
    return own.select("payable", "header_rate", "header_amount", "discount", "charges", "printed_rounding", "printed_prepayment", "says_inclusive", "stated", "printed_subtotal")


_BASE = r2("CASE WHEN disc_pct > 0 THEN quantity * price - quantity * price * disc_pct / 100.0e0 ELSE quantity * price END")
_TAX = lambda b, r: f"CASE WHEN {r} > 0 THEN {r2(f'{b} * {r} / 100.0e0')} ELSE 0.0e0 END"
_M = "DECIMAL(18,2)"
_NET = r2("CASE WHEN disc_pct > 0 THEN quantity * round(price / 1.2e0, 4) - quantity * round(price / 1.2e0, 4) * disc_pct / 100.0e0 ELSE quantity * round(price / 1.2e0, 4) END")
_SHARE = lambda pct: r2(f"CAST(b AS DOUBLE) * {pct}e0 / 100.0e0")

HEADERS_SQL = f"""{LINES_SQL},
per_line AS (SELECT *, {_TAX('b', 'rate')} AS t, {_TAX('nb', '20.0e0')} AS nt FROM (SELECT *, {_BASE} AS b, {_NET} AS nb FROM lines)),
sums AS (SELECT payable, sum(CAST(b AS {_M})) b, sum(CAST(t AS {_M})) t, sum(CAST(nb AS {_M})) nb, sum(CAST(nt AS {_M})) nt,
  sum(CAST(b AS {_M})) FILTER (item_type <> 'TAX') gb, sum(CAST(t AS {_M})) FILTER (item_type <> 'TAX') gt FROM per_line GROUP BY payable),
own AS (SELECT o_orderkey AS payable, o_orderkey % 16 AS k, coalesce(b, 0) b, coalesce(t, 0) t, coalesce(nb, 0) nb, coalesce(nt, 0) nt, coalesce(gb, 0) gb, coalesce(gt, 0) gt
  FROM orders LEFT JOIN sums ON o_orderkey = payable),
stated AS (SELECT *, CASE WHEN k IN (2, 12) THEN 19.0e0 WHEN k = 4 THEN 20.0e0 END AS header_rate,
  CASE k WHEN 3 THEN CAST(t AS DOUBLE) WHEN 8 THEN {_SHARE('10.0')} END AS header_amount,
  CASE k WHEN 6 THEN 50.0e0 END AS discount, CAST(NULL AS DOUBLE) AS charges,
  CASE k WHEN 1 THEN (payable % 5 + 1) / 100.0e0 WHEN 9 THEN 0.03e0 END AS printed_rounding,
  CASE k WHEN 2 THEN 100.0e0 WHEN 9 THEN 40.0e0 END AS printed_prepayment, k = 5 AS says_inclusive,
  CAST(CASE k WHEN 1 THEN b + t + CAST((payable % 5 + 1) / 100.0e0 AS {_M}) WHEN 2 THEN b + CAST({_SHARE('19.0')} AS {_M}) - 100
    WHEN 4 THEN b + CAST({_SHARE('20.0')} AS {_M}) WHEN 5 THEN nb + nt WHEN 7 THEN gb + gt WHEN 8 THEN b + t - CAST({_SHARE('10.0')} AS {_M})
    WHEN 9 THEN b + 0.03 - 40 WHEN 10 THEN b + t + 7.77 WHEN 11 THEN NULL WHEN 12 THEN b + CAST({_SHARE('19.0')} AS {_M}) ELSE b + t END AS {_M}) AS stated FROM own),
headers AS (SELECT *, CASE WHEN k = 8 THEN stated + 1 END AS printed_subtotal FROM stated)"""


def _taxed(spark, sf_dir):
    own = headers(spark, sf_dir)
    one = F.array(F.struct(F.col("header_rate").alias("rate"), F.col("header_amount").alias("amount")))
    return own.withColumn("taxes", F.when(F.col("header_rate").isNotNull() | F.col("header_amount").isNotNull(), one))


def erp_booked_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompute.booked(lines(spark, sf_dir), _taxed(spark, sf_dir)).select("payable", "line_base", "line_tax", "header_tax", "booked_gross")


_LINE_SUMS = f"""ls AS (SELECT payable, sum(CAST(b AS {_M})) AS lb, sum(CAST(t AS {_M})) AS lt FROM per_line GROUP BY payable)"""
_HEADER_TAX = f"CASE WHEN coalesce(header_amount, 0) = 0 AND coalesce(header_rate, 0) > 0 THEN {r2('(CAST(coalesce(lb, 0) AS DOUBLE) - coalesce(discount, 0)) * header_rate / 100.0e0')} ELSE coalesce(header_amount, 0) END"

_ERP = f"""WITH {HEADERS_SQL}, {_LINE_SUMS},
j AS (SELECT *, CAST({_HEADER_TAX} AS {_M}) AS ht FROM headers LEFT JOIN ls USING (payable))
SELECT payable, CAST(coalesce(lb, 0) AS {_M}) AS line_base, CAST(coalesce(lt, 0) AS {_M}) AS line_tax, ht AS header_tax,
  CAST(coalesce(lb, 0) - CAST(coalesce(discount, 0) AS {_M}) + coalesce(lt, 0) + ht AS {_M}) AS booked_gross FROM j"""


def line_base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    b = line_base(F.col("quantity"), F.col("price"), F.col("disc_pct"))
    return rows.groupBy("payable").agg(F.sum(b.cast(MONEY)).cast("decimal(28,2)").alias("base"), F.count("*").alias("n_lines"))


def line_tax_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).withColumn("b", line_base(F.col("quantity"), F.col("price"), F.col("disc_pct")))
    return rows.groupBy("payable", "rate").agg(F.sum(tax(F.col("b"), F.col("rate")).cast(MONEY)).cast("decimal(28,2)").alias("tax"))


def header_tax_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return erp_booked_gross(spark, sf_dir).where("header_tax <> 0").select("payable", "header_tax")


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(lines(spark, sf_dir), _taxed(spark, sf_dir))


def hypothesis_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reconciled(spark, sf_dir).withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return rows.where(F.col("licensed").bitwiseAND(F.expr("shiftleft(1, bit)")) != 0).groupBy("bit").agg(F.count("*").alias("payables"))


_LICENCE_RULES = [
    "(header_rate IS NOT NULL OR header_amount IS NOT NULL) AND coalesce(line_taxed, false)",
    "coalesce(printed_rounding, 0) <> 0",
    "(coalesce(any_rate, false) OR coalesce(header_rate, 0) > 0) AND (says_inclusive OR coalesce(extensions = stated, false))",
    "(header_rate IS NOT NULL OR header_amount IS NOT NULL) AND coalesce(line_taxed, false) AND rates = 1",
    "coalesce(printed_prepayment, 0) <> 0",
    "coalesce(discount, 0) <> 0",
    "coalesce(tax_lines, false) AND (coalesce(line_taxed, false) OR header_rate IS NOT NULL OR header_amount IS NOT NULL)",
    "coalesce(header_amount, 0) > 0 AND coalesce(stated < abs(printed_subtotal), false)",
]
_LICENSED_SQL = f"""facts AS (SELECT payable, max(coalesce(rate, 0)) > 0 AS any_rate, bool_or(rate IS NOT NULL) AS line_taxed, count(DISTINCT rate) AS rates, CAST(sum(CAST(total AS {_M})) AS {_M}) AS extensions, bool_or(item_type = 'TAX') AS tax_lines FROM lines GROUP BY payable),
lic AS (SELECT headers.*, {' + '.join(f'CASE WHEN {r} THEN {1 << k} ELSE 0 END' for k, r in enumerate(_LICENCE_RULES))} AS licensed FROM headers LEFT JOIN facts USING (payable))"""
_LICENCES = f"""WITH {HEADERS_SQL}, {_LICENSED_SQL}
SELECT CAST(bit AS INTEGER) AS bit, count(*) AS payables FROM lic, range(8) r(bit) WHERE (licensed >> CAST(bit AS INTEGER)) & 1 = 1 GROUP BY 1"""

_COSTS = "[1, 1, 2, 2, 2, 2, 2, 3]"
_ON = lambda k: f"(mask >> {k}) & 1 = 1"
_PRICE = f"CASE WHEN {_ON(2)} AND eff > 0 THEN round(price / (1 + eff / 100.0e0), 4) ELSE price END"
_RECON = f"""WITH {HEADERS_SQL}, {_LICENSED_SQL}, {_LINE_SUMS},
base AS (SELECT *, CAST(coalesce(lb, 0) - CAST(coalesce(discount, 0) AS {_M}) + coalesce(lt, 0) + CAST({_HEADER_TAX} AS {_M}) AS {_M}) AS baseline FROM lic LEFT JOIN ls USING (payable)),
masks AS (SELECT m AS mask, list_filter(range(8), lambda b: (m >> CAST(b AS INTEGER)) & 1 = 1) AS bits FROM (SELECT unnest(range(1, 256)) AS m)),
tried AS (SELECT base.*, mask, len(bits) AS size, list_sum(list_transform(bits, lambda b: ({_COSTS})[CAST(b + 1 AS INTEGER)])) AS cost, bits
  FROM base JOIN masks ON len(bits) <= 3 AND (licensed & mask) = mask WHERE stated IS NOT NULL AND stated <> baseline),
eff AS (SELECT tried.*, quantity, disc_pct, rate, price, item_type,
  coalesce(CASE WHEN rate > 0 THEN rate END, CASE WHEN NOT ({_ON(0)}) AND header_rate > 0 THEN header_rate END) AS eff
  FROM tried LEFT JOIN lines USING (payable)),
priced AS (SELECT *, {_PRICE} AS p FROM eff WHERE item_type IS NULL OR NOT ({_ON(6)} AND item_type = 'TAX')),
based AS (SELECT *, {_BASE.replace('price', 'p')} AS mb FROM priced),
summed AS (SELECT payable, mask, sum(CAST(mb AS {_M})) AS mb, sum(CAST(CASE WHEN {_ON(3)} THEN 0.0e0 ELSE {_TAX('mb', 'rate')} END AS {_M})) AS mt FROM based GROUP BY payable, mask),
heads AS (SELECT tried.*, coalesce(mb, 0) AS mb, coalesce(mt, 0) AS mt, CASE WHEN {_ON(5)} THEN 0.0e0 ELSE coalesce(discount, 0.0e0) END AS d,
  CASE WHEN {_ON(7)} AND header_amount > 0 THEN -header_amount ELSE header_amount END AS ha FROM tried LEFT JOIN summed USING (payable, mask)),
booked AS (SELECT *, CAST(mb - CAST(d AS {_M}) + mt
  + CAST(CASE WHEN {_ON(0)} THEN 0.0e0 WHEN coalesce(ha, 0) = 0 AND coalesce(header_rate, 0) > 0 THEN {r2('(CAST(mb AS DOUBLE) - d) * header_rate / 100.0e0')} ELSE coalesce(ha, 0) END AS {_M})
  + CASE WHEN {_ON(1)} THEN CAST(printed_rounding AS {_M}) ELSE 0 END - CASE WHEN {_ON(4)} THEN CAST(abs(printed_prepayment) AS {_M}) ELSE 0 END AS {_M}) AS gross FROM heads),
best AS (SELECT payable, arg_min(mask, row(size, cost, bits)) AS mask FROM booked WHERE gross = stated GROUP BY payable),
result AS (SELECT payable, CASE WHEN stated IS NULL THEN 'no_stated_total' WHEN stated = baseline THEN 'reconciled_as_read' WHEN best.mask IS NOT NULL THEN 'reconciled_with_hypothesis' ELSE 'unreconciled' END AS status,
  stated, baseline, CAST(coalesce(best.mask, 0) AS INTEGER) AS mask, CASE WHEN best.mask IS NOT NULL THEN stated ELSE baseline END AS booked FROM base LEFT JOIN best USING (payable))"""


def reconcile_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir).select("payable", "status", "stated", "baseline", "mask", "booked", "difference")


def reconcile_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.status_counts(reconciled(spark, sf_dir))


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.totals(reconciled(spark, sf_dir))


def hypothesis_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.applied_counts(reconciled(spark, sf_dir))


def unreconciled_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.unreconciled(reconciled(spark, sf_dir), 20)


def drop_itemised_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header charges that repeat some line's total, by payable: kept ones stay, others become null."""
    charges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("payable"), F.col("o_orderkey").alias("key"))
    rows = lines(spark, sf_dir)
    top = rows.groupBy("payable").agg(F.max("total").alias("top"))
    own = charges.join(top, "payable").select("payable", F.when(F.pmod("key", F.lit(3)) == 0, F.col("top")).otherwise(F.lit(12.34)).alias("freight"))
    hit = rows.join(own, "payable").where(F.col("total").cast(MONEY) == F.abs("freight").cast(MONEY)).select("payable").distinct().withColumn("hit", F.lit(True))
    return own.join(hit, "payable", "left").select("payable", F.when(F.col("hit").isNull(), F.col("freight").cast(MONEY)).alias("freight"))


def tax_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxes of a payable that repeat a rate, amount and kind count once: the first by amount of the line."""
    rows = lines(spark, sf_dir).withColumn("amount", F.round(F.col("total") / 100.0, 0)).withColumn("kind", F.when(F.col("rate") > 5, "VAT").otherwise("LEVY"))
    first = Window.partitionBy("payable", "rate", "amount", "kind").orderBy("total", "price", "quantity", "disc_pct")
    kept = rows.withColumn("n", F.row_number().over(first)).where("n = 1")
    return kept.groupBy("payable").agg(F.count("*").alias("taxes"), F.sum(F.col("total").cast(MONEY)).cast("decimal(28,2)").alias("total"))


QUERIES = {
    "erp_booked_gross": erp_booked_gross,
    "line_base": line_base_query,
    "line_tax": line_tax_query,
    "header_tax": header_tax_query,
    "hypothesis_licences": hypothesis_licences,
    "reconcile_best": reconcile_best,
    "reconcile_status_counts": reconcile_status_counts,
    "report_totals": report_totals,
    "hypothesis_histogram": hypothesis_histogram,
    "unreconciled_top20": unreconciled_top20,
    "drop_itemised_charges": drop_itemised_charges,
    "tax_dedupe": tax_dedupe,
}
ORACLE = {
    "erp_booked_gross": _ERP,
    "line_base": f"WITH {HEADERS_SQL} SELECT payable, CAST(sum(CAST(b AS {_M})) AS DECIMAL(28,2)) AS base, count(*) AS n_lines FROM per_line GROUP BY payable",
    "line_tax": f"WITH {HEADERS_SQL} SELECT payable, rate, CAST(sum(CAST(t AS {_M})) AS DECIMAL(28,2)) AS tax FROM per_line GROUP BY payable, rate",
    "header_tax": f"SELECT payable, header_tax FROM ({_ERP}) WHERE header_tax <> 0",
    "hypothesis_licences": _LICENCES,
    "reconcile_best": f"{_RECON} SELECT payable, status, stated, baseline, mask, booked, CAST(booked - stated AS {_M}) AS difference FROM result",
    "reconcile_status_counts": f"{_RECON} SELECT status, count(*) AS payables FROM result GROUP BY status",
    "report_totals": f"""{_RECON} SELECT count(*) AS payables, count(*) FILTER (starts_with(status, 'reconciled')) AS books,
  CASE WHEN count(*) = 0 THEN 0.0e0 ELSE round(count(*) FILTER (starts_with(status, 'reconciled')) / CAST(count(*) AS DOUBLE), 4) END AS book_rate FROM result""",
    "hypothesis_histogram": f"""{_RECON} SELECT ({reconcile.READINGS})[CAST(b + 1 AS INTEGER)] AS hypothesis, count(*) AS payables FROM result, range(8) r(b) WHERE (mask >> CAST(b AS INTEGER)) & 1 = 1 GROUP BY 1""",
    "unreconciled_top20": f"{_RECON} SELECT payable, stated, booked, CAST(booked - stated AS {_M}) AS difference FROM result WHERE status = 'unreconciled' ORDER BY abs(booked - stated) DESC, payable LIMIT 20",
    "drop_itemised_charges": f"""WITH {LINES_SQL}, top AS (SELECT payable, max(total) AS top FROM lines GROUP BY payable),
own AS (SELECT payable, CASE WHEN payable % 3 = 0 THEN top ELSE 12.34e0 END AS freight FROM orders JOIN top ON o_orderkey = payable)
SELECT payable, CASE WHEN NOT EXISTS (SELECT 1 FROM lines l WHERE l.payable = own.payable AND CAST(l.total AS {_M}) = CAST(abs(freight) AS {_M})) THEN CAST(freight AS {_M}) END AS freight FROM own""",
    "tax_dedupe": f"""WITH {LINES_SQL}, x AS (SELECT *, CAST(CAST(CAST(total / 100.0e0 AS VARCHAR) AS DECIMAL(38,0)) AS DOUBLE) AS amount, CASE WHEN rate > 5 THEN 'VAT' ELSE 'LEVY' END AS kind FROM lines),
k AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY payable, rate, amount, kind ORDER BY total, price, quantity, disc_pct) = 1)
SELECT payable, count(*) AS taxes, CAST(sum(CAST(total AS {_M})) AS DECIMAL(28,2)) AS total FROM k GROUP BY payable""",
}
