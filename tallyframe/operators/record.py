"""The emitted payable: a fixed structure whose leaves are texts, empty where nothing was printed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import iso_text
from tallyframe.functions.numbers import money_text, rate_text

KINDS = {"CREDIT_NOTE": "CREDIT_MEMO"}


TAX = "struct<tax_type:string,tax_name:string,tax_rate:string,tax_amount:string,tax_type_code:string>"


def _tax(type_: Column, name: Column, rate: Column, amount: Column, code: Column) -> Column:
    fields = {"tax_type": type_, "tax_name": name, "tax_rate": rate_text(rate), "tax_amount": money_text(amount), "tax_type_code": code}
    return F.struct(*[x.alias(n) for n, x in fields.items()])


def line_record(line: Column, full: bool = False, coded: bool = False) -> Column:
    """A line's struct; magnitudes for amounts, and a tax entry where a rate or amount was read. ``full``: with item type, unit and discounts."""
    rate, amount = line["tax_rate"], line["tax_amount"]
    name = F.when(rate.isNull(), "VAT").otherwise(F.concat(F.lit("VAT "), rate_text(rate), F.lit("%")))
    tax = _tax(F.lit("VAT"), name, rate, amount, line["code"] if coded else F.lit(""))
    fields = {
        "description": F.trim(F.coalesce(line["description"], F.lit(""))),
        "quantity": rate_text(F.abs(line["quantity"])),
        "unit_price": money_text(F.abs(line["unit_price"])),
        "total": money_text(F.abs(line["total"])),
        "tax_rate": rate_text(rate),
        "tax_amount": money_text(amount),
        "taxes": F.when(rate.isNotNull() | amount.isNotNull(), F.array(tax)).otherwise(F.array().cast(f"array<{TAX}>")),
    }
    if full:
        fields |= {"item_type": line["item_type"], "uom": line["uom"], "discount": money_text(F.abs(line["discount"])), "discount_percentage": rate_text(line["discount_percentage"])}
    return F.struct(*[x.alias(n) for n, x in fields.items()])


def records(readings: DataFrame) -> DataFrame:
    """(file, doc_ix, record): the emitted payable of readings, or of readings with resolved codes: twenty keys whose leaves are all texts.

    A header charge that some line's total repeats is left empty.
    """
    has = lambda c: c in readings.columns
    coded = has("supplier_id")
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if has(c) else F.lit("")
    amount = lambda c: money_text(F.abs(c))
    totals = F.transform("lines", lambda x: F.abs(x["total"]))
    charge = lambda c: F.when(F.coalesce(F.array_contains(totals, F.abs(F.col(c))), F.lit(False)), "").otherwise(amount(c))
    codes = ["company_code", "business_unit_code", "location_code"]
    buyer = F.struct(*[(F.col(f"buyer.{c}") if has("buyer") else F.lit("")).alias(c) for c in codes])
    supplier = {"name": text("supplier_name"), "supplier_id": text("supplier_id"), "address": text("supplier_address"), "vat_id": text("supplier_vat")}
    named = lambda t: F.when(F.coalesce(t["name"], F.lit("")) != "", t["name"]).otherwise(t["kind"])
    fields = {
        "invoice_number": text("number"),
        "invoice_date": iso_text(F.col("invoice_date")),
        "due_date": iso_text(F.col("due_date")),
        "invoice_type": F.when(F.col("kind") == "CREDIT_NOTE", "CREDIT_MEMO").otherwise("INVOICE"),
        "currency": text("currency"),
        "supplier": F.struct(*[x.alias(n) for n, x in supplier.items()]),
        "buyer": buyer,
        "payment_term_id": text("payment_term_id"),
        "po_number": text("po"),
        "po_id": text("po_id"),
        "gross_total": amount("printed_gross"),
        "subtotal": amount("printed_subtotal"),
        "total_tax_amount": amount("printed_tax_total"),
        "discount_amount": amount("discount"),
        "freight_charges": charge("freight"),
        "insurance_charges": charge("insurance"),
        "extra_charges": charge("extra"),
        "excise_duties": charge("excise"),
        "taxes": F.transform("taxes", lambda t: _tax(t["kind"], named(t), t["rate"], t["amount"], t["code"] if coded else F.lit(""))),
        "line_items": F.transform("lines", lambda x: line_record(x, full=True, coded=coded)),
    }
    return readings.select("file", "doc_ix", F.struct(*[x.alias(n) for n, x in fields.items()]).alias("record"))


def payables(headers: DataFrame, lines: DataFrame, key: str = "payable") -> DataFrame:
    """(key, record): headers (kind, number, currency, gross, subtotal) with their lines (description, quantity, unit_price, total, tax_rate, tax_amount) in one struct.

    Headers without lines stay; lines are ordered by all their fields.
    """
    fields = ["description", "quantity", "unit_price", "total", "tax_rate", "tax_amount"]
    listed = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))
    kind = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in KINDS.items()], F.col("kind"))
    record = F.struct(
        kind.alias("document_type"),
        F.coalesce("number", F.lit("")).alias("invoice_number"),
        F.coalesce("currency", F.lit("")).alias("currency"),
        money_text(F.abs("gross")).alias("gross_amount"),
        money_text(F.abs("subtotal")).alias("subtotal"),
        F.transform(F.coalesce("items", F.array()), lambda x: line_record(x)).alias("line_items"),
    )
    return headers.join(listed, key, "left").select(key, record.alias("record"))
