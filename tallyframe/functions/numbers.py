"""Amounts, rates and quantities as column functions. An absent number is null; ``plain_number`` alone gives 0 for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as printed: signs or a bracket, a currency sign, digits with marks and spaces between, then a percent sign, minus or bracket.
_OPENING, _MARKS, _CLOSING = r"[-+(\s]*\p{Sc}?\s*", r"[\d.,'\s\x{A0}\x{202F}]*", r"[%)-]?[\s.,:;]*"
AMOUNT_TOKEN = rf"^{_OPENING}\d{_MARKS}{_CLOSING}$"
#: ISO codes that are looked for, alphabetically.
CURRENCY_CODES = "AED ARS AUD BDT BGN BRL CAD CHF CLP CNY COP CZK DKK EGP EUR GBP GHS HKD HRK HUF IDR ILS INR JPY KES KRW LKR MAD MXN MYR NGN NOK NPR NZD PEN PHP PKR PLN RON RSD RWF SAR SEK SGD THB TRY TWD TZS UAH UGX USD VND XAF XOF ZAR ZMW".split()
#: Symbols of more than one character first, in order.
CURRENCY_SYMBOLS = [("R$", "BRL"), ("RM", "MYR"), ("KSh", "KES"), ("zł", "PLN"), ("Kč", "CZK"), ("kr", "SEK"), ("CHF", "CHF"), ("€", "EUR"), ("$", "USD"), ("£", "GBP"), ("¥", "JPY"), ("₹", "INR"), ("₵", "GHS"), ("₦", "NGN"), ("R", "ZAR"), ("₺", "TRY"), ("₴", "UAH"), ("₪", "ILS")]


def looks_like_amount(text: Column) -> Column:
    """Whether a printed token is a number rather than an identifier."""
    trimmed = F.trim(text)
    return F.coalesce((F.length(trimmed) > 0) & trimmed.rlike(AMOUNT_TOKEN), F.lit(False))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value bound once: an expression that f names often would otherwise be copied as often."""
    return F.get(F.transform(F.array(value), f), 0)


def _amount(body: Column) -> Column:
    """The number of digits and separators: the last separator is decimal, except one kind before three digits and a head that isn't 0."""
    tail = F.regexp_extract(body, r"[.,]([0-9]*)$", 1)
    mark = F.regexp_extract(body, r"([.,])[0-9]*$", 1)
    head = F.regexp_extract(body, r"^([0-9]*)", 1)
    one_kind = ~(F.contains(body, F.lit(".")) & F.contains(body, F.lit(",")))
    grouped = (F.length(tail) == 3) & one_kind & ~head.isin("0", "")
    broken = F.concat(F.regexp_replace(F.regexp_extract(body, r"^(.*)[.,][0-9]*$", 1), "[.,]", ""), F.lit("."), tail)
    digits = F.when((mark == "") | grouped, F.regexp_replace(body, "[.,]", "")).otherwise(broken)
    return F.when(body.rlike("[0-9]"), digits.try_cast("decimal(28,6)"))


def parse_amount(text: Column) -> Column:
    """A printed amount as decimal(28,6), whatever its thousands and decimal marks; null without digits."""
    bracketed = r"^\(.*\)$"

    def made(raw: Column) -> Column:
        inner = F.when(raw.rlike(bracketed), F.regexp_replace(raw, r"^\((.*)\)$", "$1")).otherwise(raw)
        minus = raw.rlike(bracketed) | inner.rlike("-$|^-")
        number = let(F.regexp_replace(raw, r"[^0-9.,]", ""), _amount)
        return F.when(minus, -number).otherwise(number).cast("decimal(28,6)")

    return let(F.trim(text), made)


def plain_number(text: Column) -> Column:
    """The recompute's reading of a dot-decimal text: percent and leading currency signs dropped, anything else 0."""
    kept = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.trim(text), "%", "")), r"^[€$£¥₹ \t]+", ""))
    return F.when(kept.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), kept.try_cast("double")).otherwise(F.lit(0.0))


def money_text(value: Column) -> Column:
    """Two decimals, half up; null gives an empty text."""
    return F.coalesce(value.cast("decimal(38,6)").cast("decimal(38,2)").cast("string"), F.lit(""))


def rate_text(value: Column) -> Column:
    """No trailing zeros; null gives an empty text."""
    plain = value.cast("decimal(38,6)").cast("string")
    return F.coalesce(F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""), F.lit(""))


def round2(value: Column) -> Column:
    return F.round(value.cast("double"), 2)


def rate_key(value: Column) -> Column:
    """A rate to two decimals, half even, as the key of the tax master."""
    return F.bround(value.cast("decimal(28,6)"), 2).cast("decimal(9,2)")


def detect_currency(text: Column) -> Column:
    """The currency a text states: an ISO code, alphabetically first, else a symbol; empty without one."""
    upper = F.upper(text)
    code = F.array_min(F.regexp_extract_all(upper, F.lit(f"(?<![A-Z])({'|'.join(CURRENCY_CODES)})(?![A-Z])"), F.lit(1)))
    symbols = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(c).alias("c")) for s, c in CURRENCY_SYMBOLS])
    symbol = F.get(F.filter(symbols, lambda x: F.contains(text, x["s"])), 0)["c"]
    return F.coalesce(code, symbol, F.lit(""))
