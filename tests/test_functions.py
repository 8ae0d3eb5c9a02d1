from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates, numbers, similarity, text

AMOUNTS = {"1.234,56": "1234.56", "1,234.56": "1234.56", "1 234,56": "1234.56", "1'234.56": "1234.56", "1234": "1234", "0,00": "0", "(120.00)": "-120", "120,00-": "-120", "€ 1.500,00": "1500", "12,5": "12.5", "1.500": "1500", "0.125": "0.125", "": None, "n/a": None, "0": "0", None: None, "(": None, "-5": "-5", "1.234.567,891": "1234567.891"}


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_parse_amount(spark):
    got = one(spark, AMOUNTS, numbers.parse_amount)
    assert got == [None if v is None else Decimal(v).quantize(Decimal("0.000001")) for v in AMOUNTS.values()]


def test_looks_like_amount(spark):
    yes, no = ["1.254,00", "(120.00)", "19%"], ["DE209177122", "GHA-VAT-887766", "EUR", "2026-0455", "", None]
    assert one(spark, yes + no, numbers.looks_like_amount) == [True] * len(yes) + [False] * len(no)


def test_plain_number(spark):
    values = {"12.50": 12.5, "€ 3": 3.0, "19%": 19.0, "1e3": 1000.0, "1.0d": 0.0, "": 0.0, None: 0.0, "abc": 0.0, "-4": -4.0, ".5": 0.5}
    assert one(spark, values, numbers.plain_number) == list(values.values())


@pytest.mark.parametrize("printed,iso", [("02.02.2026", "2026-02-02"), ("2026-03-04", "2026-03-04"), ("11/03/2026", "2026-03-11"), ("4 March 2026", "2026-03-04"), ("4. Marz 2026", "2026-03-04"), ("March 4, 2026", "2026-03-04"), ("03/25/26", "2026-03-25"), ("31.02.2026", None), ("none", None), (None, None)])
def test_parse_date(spark, printed, iso):
    got = one(spark, [printed], dates.parse_date)[0]
    assert (str(got) if got else None) == iso


def test_formats(spark):
    df = spark.range(1).select(numbers.money_text(F.lit(1234.5)), numbers.money_text(F.lit(None)), numbers.rate_text(F.lit(19.5)), numbers.rate_text(F.lit(20)), numbers.rate_text(F.lit(None)), dates.iso_text(F.lit(None)))
    assert tuple(df.first()) == ("1234.50", "", "19.5", "20", "", "")


def test_currency(spark):
    assert one(spark, ["12 EUR", "RM 5", "", "none", "5 zł"], numbers.detect_currency) == ["EUR", "MYR", "", "", "PLN"]


def test_text(spark):
    assert one(spark, ["  Ärger\n Ça  va", None], text.fold) == ["arger ca va", ""]
    assert one(spark, ["Invoice 12", "total"], lambda c: text.label_position(text.fold(c), F.lit("total"))) == [0, 1]
    assert one(spark, ["INV 12", "x", "No. A-7;"], text.clean_identifier) == ["INV 12", "", "No A-7"]
    assert one(spark, ["ust VAT 5", "Customer pay"], text.item_type) == ["TAX", "GOODS"]


def test_similarity():
    assert similarity.common_length("abcbdab", "bdcaba") == 4 and similarity.common_length("", "a") == 0
    assert similarity.token_set_ratio("acme ltd", "acme ltd berlin") == 100.0 and similarity.token_set_ratio("", "x") == 0.0
    assert 80 < similarity.token_set_ratio("nordwind gmbh", "nordwint gmbh") < 100
