"""Reconciliation: the fewest licensed readings under which a payable books its own stated total.

Eight readings are bits of a mask, in the order in which they apply (by cost, then by rank):

 0 header_tax_restates_line_tax 1 (cost)    1 rounding_difference 1            2 tax_inclusive_prices 2
 3 line_tax_restates_header_tax 2           4 prepayment_already_paid 2        5 header_discount_already_in_lines 2
 6 tax_line_duplicates_tax 2                7 withholding_reduces_total 3

Only readings 0, 2, 3 and 6 touch lines, so the lines are summed once for each of their twelve variants (one
shuffle by payable). For a payable that doesn't book its stated total, the masks of up to three of its licensed bits (at
most 92) are tried in one expression on its row: the first in (size, cost, enumeration) order that books the stated
total wins. A payable that books its total as read is never changed.

Lines: payable, quantity, price, disc_pct, rate, total, item_type, and as far as they have them disc_amount, tax_amount, taxes.
Headers: payable, stated, taxes (array of rate and amount), discount, charges, printed_rounding, printed_prepayment,
printed_subtotal, says_inclusive.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.recompute import CHARGES, MONEY, charges, header_tax, line_base, line_tax, or_null, zero
from tallyframe.sources.staging import staged

READINGS = ["header_tax_restates_line_tax", "rounding_difference", "tax_inclusive_prices", "line_tax_restates_header_tax", "prepayment_already_paid", "header_discount_already_in_lines", "tax_line_duplicates_tax", "withholding_reduces_total"]
COSTS = [1, 1, 2, 2, 2, 2, 2, 3]
#: Masks of up to three readings, the preferred first.
MASKS = [sum(1 << k for k in c) for _, _, _, c in sorted((n, sum(COSTS[k] for k in c), e, c) for n in (1, 2, 3) for e, c in enumerate(combinations(range(8), n)))]


#: For each set of licensed readings the masks within it, the preferred first.
WITHIN = ";".join(",".join(str(m) for m in MASKS if m & licensed == m) or "0" for licensed in range(256))
#: inclusive: 0 as printed, 1 net of the effective rate, 2 the same when header taxes are gone; cleared line taxes; dropped TAX lines.
VARIANTS = [(i, c, d) for i in (0, 1, 2) for c in (0, 1) for d in (0, 1)]


def line_sums(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """headers with, for each variant, the lines' base and tax; and what licences ask of the lines."""
    some_rate = F.filter(F.transform("taxes", lambda t: t["rate"].cast("double")), lambda r: F.coalesce(r != 0, F.lit(False)))
    headers = headers.withColumn("header_rate", F.when(F.size(some_rate) == 1, F.get(some_rate, 0)))
    rows = headers.select("payable", "header_rate").join(lines, "payable")
    own = F.when(F.col("rate") > 0, F.col("rate").cast("double"))
    disc_amount = or_null(lines, "disc_amount")
    # what a line comes to under each price is computed once, before the sums that take it
    for i in (0, 1, 2):
        effective = F.lit(None).cast("double") if not i else own if i == 2 else F.coalesce(own, F.when(F.col("header_rate") > 0, F.col("header_rate")))
        price = F.when(effective > 0, F.bround((F.col("price").cast("decimal(28,10)") / (1 + effective.cast("decimal(28,10)") / 100)).cast("decimal(28,10)"), 4).cast("double")).otherwise(F.col("price").cast("double"))
        base = line_base(F.col("quantity"), price, F.col("disc_pct"), disc_amount)
        rows = rows.withColumn(f"__b{i}", base)
        rows = rows.withColumn(f"__t{i}", line_tax(lines, F.col(f"__b{i}"))).withColumn(f"__b{i}", F.col(f"__b{i}").cast(MONEY))
    keep = [F.lit(True), F.col("item_type") != "TAX"]
    aggregates = [F.sum(F.when(keep[d], F.col(f"__{n}{i}"))).alias(f"{n}{i}{d}") for n in "bt" for i in (0, 1, 2) for d in (0, 1)]
    has_tax = F.col("rate").isNotNull() | or_null(lines, "tax_amount").isNotNull()
    facts = [F.max(has_tax).alias("line_taxed"), F.max(F.col("rate") > 0).alias("any_rate"), F.count_distinct("rate").alias("rates"), F.sum(F.col("total").cast(MONEY)).cast(MONEY).alias("extensions"), F.max(F.col("item_type") == "TAX").alias("tax_lines")]
    sums = rows.groupBy("payable").agg(*facts, *aggregates)
    none = F.lit(0).cast(MONEY)
    money = lambda n, i, d: F.coalesce(F.col(f"{n}{i}{d}").cast(MONEY), none)
    bases = F.array(*[money("b", i, d) for i, c, d in VARIANTS]).alias("bases")
    taxes = F.array(*[none if c else money("t", i, d) for i, c, d in VARIANTS]).alias("line_taxes")
    return headers.join(sums, "payable", "left").select(*headers.columns, "line_taxed", "any_rate", "rates", "extensions", "tax_lines", bases, taxes)


def licences(df: DataFrame) -> DataFrame:
    """df with ``licensed``: a bit for each reading that the page prints the evidence for."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    has_header, line_taxed = yes(F.size("taxes") > 0), yes(F.col("line_taxed"))
    rated = yes(F.col("any_rate")) | yes(F.exists("taxes", lambda t: t["rate"] > 0))
    rules = [
        has_header & line_taxed,
        zero(F.col("printed_rounding")) != 0,
        rated & (yes(F.col("says_inclusive")) | yes(F.col("extensions") == F.col("stated"))),
        has_header & line_taxed & (F.col("rates") == 1),
        zero(F.col("printed_prepayment")) != 0,
        zero(F.col("discount")) != 0,
        yes(F.col("tax_lines")) & (has_header | line_taxed),
        yes(F.exists("taxes", lambda t: t["amount"] > 0)) & yes(F.col("stated") < F.abs(F.col("printed_subtotal"))),
    ]
    bits = F.lit(0)
    for k, rule in enumerate(rules):
        bits = bits + F.when(F.coalesce(rule, F.lit(False)), 1 << k).otherwise(0)
    return df.withColumn("licensed", bits)


def gross_under(mask: Column) -> Column:
    """The gross that a row of ``line_sums`` books under a mask."""
    on = lambda k: mask.bitwiseAND(F.lit(1 << k)) != 0
    inclusive = F.when(on(2) & on(0), 2).when(on(2), 1).otherwise(0)
    at = inclusive * 4 + F.when(on(3), 2).otherwise(0) + F.when(on(6), 1).otherwise(0)
    base, taxes = F.get("bases", at), F.get("line_taxes", at)
    discount = F.when(on(5), 0.0).otherwise(F.abs(zero(F.col("discount"))))
    plain = F.transform("taxes", lambda t: F.struct(t["rate"].cast("double").alias("rate"), F.when(on(7) & (t["amount"] > 0), -t["amount"].cast("double")).otherwise(t["amount"].cast("double")).alias("amount")))
    taxed = F.when(on(0), F.lit(0).cast(MONEY)).otherwise(header_tax(plain, base.cast("double") - discount))
    rounding = F.when(on(1), zero(F.col("printed_rounding"))).otherwise(0.0).cast(MONEY)
    prepaid = F.when(on(4), F.abs(zero(F.col("printed_prepayment")))).otherwise(0.0).cast(MONEY)
    return (base - discount.cast(MONEY) + taxes + taxed + F.col("all_charges") + rounding - prepaid).cast(MONEY)


def reconcile(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """(payable, status, stated, baseline, licensed, mask, booked, difference, applied) of each header."""
    # headers are read twice: with their lines for the rate, and with the sums
    headers = staged(headers.withColumn("all_charges", charges(headers)).withColumn("stated", F.col("stated").cast(MONEY)), "headers")
    rows = licences(line_sums(lines, headers)).withColumn("baseline", gross_under(F.lit(0)))
    within = F.split(F.get(F.split(F.lit(WITHIN), ";"), F.col("licensed")), ",").cast("array<int>")
    tried = F.get(F.filter(within, lambda m: gross_under(m) == F.col("stated")), 0)
    rows = rows.withColumn("mask", F.coalesce(F.when((F.col("stated") != F.col("baseline")) & (F.col("licensed") > 0), tried), F.lit(0)))
    status = F.when(F.col("stated").isNull(), "no_stated_total").when(F.col("stated") == F.col("baseline"), "reconciled_as_read").when(F.col("mask") > 0, "reconciled_with_hypothesis").otherwise("unreconciled")
    applied = F.concat_ws(",", *[F.when(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0, n) for k, n in enumerate(READINGS)])
    booked = F.when(F.col("mask") > 0, F.col("stated")).otherwise(F.col("baseline"))
    return rows.select("payable", status.alias("status"), "stated", "baseline", "licensed", "mask", booked.alias("booked"), (booked - F.col("stated")).cast(MONEY).alias("difference"), applied.alias("applied"))


def as_payables(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, headers) of readings for ``reconcile``; magnitudes, as credit notes are delivered. A charge that some line's total repeats is no header charge."""
    own = readings.withColumn("payable", F.struct("file", "doc_ix"))
    totals = F.transform("lines", lambda x: F.abs(x["total"]).cast(MONEY))
    kept = lambda c: F.when(~F.coalesce(F.array_contains(totals, F.abs(F.col(c)).cast(MONEY)), F.lit(False)), F.abs(c).cast(MONEY)).alias(c)
    money = lambda c: F.abs(c).cast(MONEY).alias(c)
    taxes = F.transform("taxes", lambda t: F.struct(t["rate"].cast("double").alias("rate"), t["amount"].cast("double").alias("amount")))
    headers = own.select("payable", F.abs(F.col("printed_gross")).cast(MONEY).alias("stated"), taxes.alias("taxes"), money("discount"), *[kept(c) for c in CHARGES if c in own.columns], "printed_rounding", money("printed_prepayment"), money("printed_subtotal"), "says_inclusive")
    line = lambda f: F.abs(F.col(f"x.{f}")).cast("double")
    price = F.round(F.abs("x.unit_price"), 2).cast("double").alias("price")
    each = own.select("payable", F.explode("lines").alias("x"))
    lines = each.select("payable", line("quantity").alias("quantity"), price, F.coalesce(line("discount_percentage"), F.lit(0.0)).alias("disc_pct"), line("discount").alias("disc_amount"), F.col("x.tax_rate").cast("double").alias("rate"), F.col("x.tax_amount").cast("double").alias("tax_amount"), line("total").alias("total"), F.col("x.item_type").alias("item_type"))
    return lines, headers


def reconcile_readings(readings: DataFrame) -> DataFrame:
    """``reconcile`` of readings, with their file and doc_ix."""
    lines, headers = as_payables(staged(readings, "readings"))
    return reconcile(lines, headers).select("payable.file", "payable.doc_ix", "*").drop("payable")
