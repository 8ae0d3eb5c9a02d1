"""The booking system's recompute: the gross that a payable books, from its lines, taxes and charges.

A line's base is quantity times price less its discount (a percentage before an amount, the amount spread over
the units), rounded half up to cents. A tax whose amount is 0 and whose rate is positive is derived from its base
and rounded. Header taxes apply to the lines' bases less the header discount. Rounded parts are summed as
decimals, so the sum doesn't depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numbers import let, plain_number, round2

MONEY = "decimal(18,2)"


def zero(x: Column) -> Column:
    return F.coalesce(x.cast("double"), F.lit(0.0))


def line_base(quantity: Column, price: Column, disc_pct: Column, disc_amount: Column | None = None) -> Column:
    q, p, pct = zero(quantity), zero(price), F.abs(zero(disc_pct))
    amount = F.abs(zero(disc_amount)) if disc_amount is not None else F.lit(0.0)
    plain = q * p
    by_pct = plain - plain * pct / F.lit(100.0)
    by_amount = (p - amount / F.nullif(F.abs(q), F.lit(0.0))) * q
    return round2(F.when(pct > 0, by_pct).when((amount > 0) & (q != 0), by_amount).otherwise(plain))


def tax(base: Column, rate: Column, amount: Column | None = None) -> Column:
    """A stated amount, or the rate's share of the base where the amount is 0 or absent and the rate positive."""
    r, a = zero(rate), zero(amount) if amount is not None else F.lit(0.0)
    return F.when((a == 0) & (r > 0), round2(base * r / F.lit(100.0))).otherwise(a)


#: Charges of a header, signed as they stand.
CHARGES = ["freight", "insurance", "extra", "excise", "charges"]


def or_null(df: DataFrame, name: str, kind: str = "double") -> Column:
    """A column of df, or a null where df has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def line_tax(df: DataFrame, base: Column) -> Column:
    """The tax of a line: the sum of its ``taxes`` where it has any, else that of its rate and tax_amount."""
    alone = tax(base, or_null(df, "rate"), or_null(df, "tax_amount"))
    if "taxes" not in df.columns:
        return alone.cast(MONEY)
    each = F.aggregate("taxes", F.lit(0).cast("decimal(38,2)"), lambda s, t: (s + tax(base, t["rate"], t["amount"]).cast(MONEY)).cast("decimal(38,2)"))
    return F.when(F.size("taxes") > 0, each).otherwise(alone).cast(MONEY)


def header_tax(taxes: Column, net: Column) -> Column:
    """The sum of header taxes (rate, amount) on a net base."""
    none = F.array().cast("array<struct<rate:double,amount:double>>")
    plain = F.transform(taxes, lambda t: F.struct(t["rate"].cast("double").alias("rate"), t["amount"].cast("double").alias("amount")))
    return F.aggregate(F.coalesce(plain, none), F.lit(0).cast("decimal(38,2)"), lambda s, t: (s + tax(net, t["rate"], t["amount"]).cast(MONEY)).cast("decimal(38,2)")).cast(MONEY)


def charges(df: DataFrame) -> Column:
    """The header's charges together, each rounded."""
    found = [zero(F.col(c)).cast(MONEY) for c in CHARGES if c in df.columns]
    total = F.lit(0).cast(MONEY)
    for c in found:
        total = (total + c).cast(MONEY)
    return total


def booked(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """headers with line_base, line_tax, header_tax, booked_gross.

    lines: payable, quantity, price, disc_pct, and as far as they have them disc_amount, rate, tax_amount and taxes (an array of
    rate and amount, before the two). headers: payable, discount, taxes and any of ``CHARGES``. Payables without lines are
    kept. One shuffle by payable, combined on the map side.
    """
    base = line_base(F.col("quantity"), F.col("price"), F.col("disc_pct"), or_null(lines, "disc_amount"))
    per_line = lines.withColumn("base", base)
    per_line = per_line.withColumn("own_tax", line_tax(per_line, F.col("base")))
    sums = per_line.groupBy("payable").agg(F.sum(F.col("base").cast(MONEY)).alias("line_base"), F.sum("own_tax").alias("line_tax"))
    none = F.lit(0).cast(MONEY)
    joined = headers.join(sums, "payable", "left").withColumn("line_base", F.coalesce("line_base", none)).withColumn("line_tax", F.coalesce("line_tax", none))
    net = F.col("line_base").cast("double") - F.abs(zero(F.col("discount")))
    joined = joined.withColumn("header_tax", header_tax(F.col("taxes"), net))
    gross = F.col("line_base") - F.abs(zero(F.col("discount"))).cast(MONEY) + F.col("line_tax") + F.col("header_tax") + charges(headers)
    return joined.withColumn("line_base", F.col("line_base").cast(MONEY)).withColumn("line_tax", F.col("line_tax").cast(MONEY)).withColumn("booked_gross", gross.cast(MONEY))


def book_records(records: DataFrame, record: str = "record") -> DataFrame:
    """(booked_gross) of records in the emitted form, one row each: amounts are read from their texts."""
    number = lambda x: plain_number(x)

    def of_line(x: Column) -> Column:
        base = line_base(number(x["quantity"]), number(x["unit_price"]), number(x["discount_percentage"]), number(x["discount"]))
        own = F.when(F.size(x["taxes"]) > 0, F.transform(x["taxes"], lambda t: F.struct(t["tax_rate"].alias("r"), t["tax_amount"].alias("a")))).otherwise(F.array(F.struct(x["tax_rate"].alias("r"), x["tax_amount"].alias("a"))))
        return let(F.struct(base.alias("b"), own.alias("t")), lambda y: F.struct(y["b"].cast(MONEY).alias("base"), F.aggregate(y["t"], F.lit(0).cast("decimal(38,2)"), lambda s, t: (s + tax(y["b"], number(t["r"]), number(t["a"])).cast(MONEY)).cast("decimal(38,2)")).alias("tax")))

    r = F.col(record)
    sums = F.transform(r["line_items"], of_line)
    total = lambda f: F.aggregate(F.transform("__lines", lambda x: x[f].cast("decimal(38,2)")), F.lit(0).cast("decimal(38,2)"), lambda s, x: (s + x).cast("decimal(38,2)"))
    off = F.abs(number(r["discount_amount"]))
    rated = F.transform(r["taxes"], lambda t: F.struct(number(t["tax_rate"]).alias("rate"), number(t["tax_amount"]).alias("amount")))
    added = sum((number(r[c]).cast(MONEY) for c in ("freight_charges", "insurance_charges", "extra_charges", "excise_duties")), F.lit(0).cast("decimal(38,2)"))
    rows = records.withColumn("__lines", sums).withColumn("__base", total("base"))
    gross = F.col("__base") - off.cast(MONEY) + total("tax") + header_tax(rated, F.col("__base").cast("double") - off) + added
    return rows.withColumn("booked_gross", gross.cast(MONEY)).drop("__lines", "__base")
