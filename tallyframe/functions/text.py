"""Text folding, tokens, labels and identifiers as column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions import vocabulary as v

#: Accented Latin letters and their plain forms; folding by one table keeps a text's length.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďđēęěğīłńňōőřśšťūůűźżž"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaaaccddeeegilnnoorsstuuuzzz"


def fold(text: Column) -> Column:
    """Lower case, accents dropped, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, PLAIN), r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(fold(text), r"[^a-z0-9]+"), lambda x: x != "")


def id_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def label_position(folded: Column, label: Column) -> Column:
    """Where a label first stands as a whole word in a folded text, from 1; 0 if nowhere. Labels hold letters, digits, spaces."""
    return F.regexp_instr(folded, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), label, F.lit(r"(?![\p{L}\p{N}])")))


def contains_any(folded: Column, phrases: list[str]) -> Column:
    """The longest of the phrases that a folded text contains, the first of equals; null if none."""
    ordered = sorted(phrases, key=len, reverse=True)
    return F.get(F.filter(F.array(*[F.lit(p) for p in ordered]), lambda p: F.contains(folded, p)), 0)


def clean_identifier(text: Column) -> Column:
    """The first token that has a digit of a printed number's first two, with a prefix of at most four letters; 40 characters."""
    words = F.transform(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""), lambda w: F.btrim(w, F.lit(".,;:#")))
    first, second = F.coalesce(F.get(words, 0), F.lit("")), F.coalesce(F.get(words, 1), F.lit(""))
    prefixed = first.rlike("^[A-Za-z]{1,4}$")
    return F.when(first.rlike("[0-9]"), F.substring(first, 1, 40)).when(second.rlike("[0-9]"), F.substring(F.when(prefixed, F.concat(first, F.lit(" "), second)).otherwise(second), 1, 40)).otherwise(F.lit(""))


def vat_ids(text: Column) -> Column:
    """Registration numbers: two letters and digits, then the Ghanaian form; each once, in order."""
    upper = F.upper(text)
    general = F.transform(F.regexp_extract_all(upper, F.lit(r"\b[A-Z]{2} ?[0-9][0-9A-Z]{6,13}\b"), F.lit(0)), lambda x: F.replace(x, F.lit(" "), F.lit("")))
    return F.array_distinct(F.concat(general, F.regexp_extract_all(upper, F.lit(r"\bGHA-VAT-[0-9]{4,10}\b"), F.lit(0))))


def ibans(text: Column) -> Column:
    return F.regexp_extract_all(F.upper(text), F.lit(r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\b"), F.lit(0))


def email(text: Column) -> Column:
    return F.regexp_extract(text, r"([A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]+)", 1)


_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"


def alternatives(words: list[str]) -> str:
    """A pattern of the words, the longest first."""
    return "|".join(re.sub(r"([^\w ])", r"\\\1", w) for w in sorted(words, key=len, reverse=True))


def any_of(folded: Column, phrases: list[str]) -> Column:
    """Whether a folded text contains one of the phrases."""
    return folded.rlike(alternatives(phrases))


def whole_words(folded: Column, phrases: list[str]) -> Column:
    """Whether one of the phrases stands in a folded text as whole words."""
    return folded.rlike(f"{_BEFORE}(?:{alternatives(phrases)}){_AFTER}")


def mentions(folded: Column, phrases: list[str], short: int = 4) -> Column:
    """Whether a folded text contains one of the phrases; those of up to ``short`` characters count only as whole words."""
    few, more = [w for w in phrases if len(w) <= short], [w for w in phrases if len(w) > short]
    found = [whole_words(folded, few)] * bool(few) + [any_of(folded, more)] * bool(more)
    return found[0] | found[1] if len(found) > 1 else found[0] if found else F.lit(False)


def label_in(folded: Column, labels: list[str]) -> Column:
    """The longest of the labels that stands in a folded text as whole words, the first of equals; null without."""
    # the labels stand inside a lookahead, so that one found doesn't hide another that overlaps it
    found = F.regexp_extract_all(folded, F.lit(f"{_BEFORE}(?=({alternatives(labels)}){_AFTER})"), F.lit(1))
    ranked = F.transform(found, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("label")))
    return F.array_min(ranked)["label"]


def text_after(text: Column, label: Column) -> Column:
    """What stands after a label in a text, as printed but for squeezed white space; colons and dashes around it are dropped."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    at = F.regexp_instr(fold(plain), F.concat(F.lit(_BEFORE + "\\Q"), label, F.lit("\\E" + _AFTER)))
    after = F.when(at > 0, F.substr(plain, at + F.length(label))).otherwise(F.lit(""))
    return F.btrim(F.regexp_replace(F.coalesce(after, F.lit("")), "[:：]", " "), F.lit(" .-–—\t"))


def item_type(description: Column) -> Column:
    """FREIGHT before TAX (short lines only) before SERVICE before GOODS."""
    folded = fold(description)
    return F.when(mentions(folded, v.FREIGHT), "FREIGHT").when(mentions(folded, v.TAX) & (F.length(folded) < 30), "TAX").when(mentions(folded, v.SERVICE), "SERVICE").otherwise("GOODS")


def tax_kind(text: Column) -> Column:
    folded = fold(text)
    return F.when(any_of(folded, ["iva"]), "IVA").when(any_of(folded, ["gst"]), "GST").when(any_of(folded, ["sst"]), "SST").when(any_of(folded, v.WITHHOLDING), "WHT").when(any_of(folded, ["levy", "nhil", "getfund"]), "LEVY").otherwise("VAT")


def prices_include_tax(text: Column) -> Column:
    """True or false as a text says, null where it says neither."""
    folded = fold(text)
    return F.when(any_of(folded, v.TAX_INCLUSIVE), True).when(any_of(folded, v.TAX_EXCLUSIVE), False)


def reverse_charge(text: Column) -> Column:
    return any_of(fold(text), v.REVERSE_CHARGE)
