import json

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.text import fold
from tallyframe.operators import layout, masters, reconcile, recompute, report
from tallyframe.plans import pages
from tallyframe.sources import readers
from tallyframe.streaming import folder

HEADER = "payable long, header_rate double, header_amount double, discount double, charges double, printed_rounding double, printed_prepayment double, says_inclusive boolean, stated double, printed_subtotal double"
LINE = "payable long, quantity double, price double, disc_pct double, rate double, item_type string, total double"


def settle(spark, lines, **header):
    names = [c.split()[0] for c in HEADER.split(", ")]
    own = spark.createDataFrame([tuple({"payable": 1, **header}.get(n) for n in names)], HEADER)
    one = F.array(F.struct(F.col("header_rate").alias("rate"), F.col("header_amount").alias("amount")))
    own = own.withColumn("taxes", F.when(F.coalesce("header_rate", "header_amount").isNotNull(), one).otherwise(F.slice(one, 1, 0)))
    rows = spark.createDataFrame([(1, *x) for x in lines], LINE)
    return reconcile.reconcile(rows, own).first()


TWO = [(1.0, 100.0, None, 20.0, "GOODS", 100.0)] * 2


@pytest.mark.parametrize(
    "lines,header,status,applied,booked",
    [
        (TWO, {"stated": 240.0}, "reconciled_as_read", "", 240),
        (TWO, {"stated": 240.0, "header_rate": 20.0}, "reconciled_with_hypothesis", "header_tax_restates_line_tax", 240),
        ([(1.0, 124.0, None, 24.0, "GOODS", 124.0)], {"stated": 124.0}, "reconciled_with_hypothesis", "tax_inclusive_prices", 124),
        ([(1.0, 1000.0, None, None, "GOODS", 1000.0)], {"stated": 600.0, "printed_prepayment": 400.0}, "reconciled_with_hypothesis", "prepayment_already_paid", 600),
        ([(1.0, 100.0, None, None, "GOODS", 100.0)], {"stated": 1000000.0, "printed_prepayment": 1.0}, "unreconciled", "", 100),
        (TWO, {"stated": None}, "no_stated_total", "", 240),
        ([(1.0, 100.0, None, None, "GOODS", 100.0)], {"stated": 90.0, "header_amount": 10.0, "printed_subtotal": 100.0}, "reconciled_with_hypothesis", "withholding_reduces_total", 90),
        (TWO + [(1.0, 41.0, None, None, "TAX", 41.0)], {"stated": 240.0}, "reconciled_with_hypothesis", "tax_line_duplicates_tax", 240),
        (TWO, {"stated": 240.03, "discount": 5.0, "printed_rounding": 0.03}, "reconciled_with_hypothesis", "rounding_difference,header_discount_already_in_lines", 240.03),
    ],
)
def test_reconcile(spark, lines, header, status, applied, booked):
    got = settle(spark, lines, **header)
    assert (got.status, got.applied, float(got.booked)) == (status, applied, booked)


def test_documented_example(spark):
    lines = spark.createDataFrame([(1, 4.0, 73.0, None, None, "GOODS", 292.0), (1, 2.0, 73.0, None, None, "GOODS", 146.0)], LINE)
    header = spark.createDataFrame([(1, None, None, None)], "payable long, discount double, charges double, taxes array<struct<rate:double,amount:double>>")
    assert float(recompute.booked(lines, header).first().booked_gross) == 438.0


def test_discount_by_amount_and_derived_tax(spark):
    row = spark.range(1).select(recompute.line_base(F.lit(3), F.lit(10), F.lit(None), F.lit(1.0)), recompute.tax(F.lit(100.0), F.lit(19.0), F.lit(0.0)), recompute.tax(F.lit(100.0), F.lit(19.0), F.lit(5.0)), recompute.line_base(F.lit(0), F.lit(10), F.lit(None), F.lit(1.0))).first()
    assert tuple(row) == (29.0, 19.0, 5.0, 0.0)


def test_column_bounds_and_anchors(spark):
    words = spark.createDataFrame([(1, i, w, i * 30.0, i * 30.0 + 20, 0.0, 10.0) for i, w in enumerate("Item Unit Price Total".split())], "page int, word_ix int, text string, x0 double, x1 double, top double, bottom double")
    placed = layout.row_clusters(words)
    found = layout.anchors(placed, [("unit_price", "unit price"), ("total", "total"), ("total", "price"), ("description", "item")])
    assert sorted((r.kind, r.x0, r.x1) for r in found.collect()) == [("description", 0.0, 20.0), ("total", 90.0, 110.0), ("unit_price", 30.0, 80.0)]
    bounds = {r.kind: (r.left, r.right) for r in layout.column_bounds(found).collect()}
    assert bounds["unit_price"] == (25.0, 85.0) and bounds["total"][1] == float("inf")


def test_candidates_are_bounded(spark):
    master = spark.range(400).selectExpr("id", "concat('common name', id % 7) AS name")
    index = masters.postings(master, F.col("name"), "id")
    asked = spark.createDataFrame([(1, "common name3")], "q int, name string")
    assert masters.candidates(asked, F.col("name"), "q", index, 400).count() == 25


def test_sources(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for name in ("a/x.pdf", "a/b/x.pdf", "a/y.txt"):
        (tmp_path / name).write_bytes(name.encode())
    found = readers.files(spark, str(tmp_path), only="X")
    assert found.count() == 2

    def read(content):
        if b"b/" in content:
            raise ValueError("broken")
        return [(1, w, 0.0, 1.0, 0.0, 1.0) for w in content.decode().split("/")]

    rows = readers.words(found, read).collect()
    assert sorted(r.text for r in rows if r.error is None) == ["a", "x.pdf"] and [r.error for r in rows if r.error] == ["ValueError: broken"]
    assert readers.page_stubs(found, F.lit(3)).count() == 6
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"suppliers": [{"supplier_id": "S1", "name": "A"}, None]}))
    assert [tuple(r) for r in readers.master(spark, str(path), "suppliers", "supplier_id string, name string").collect()] == [("S1", "A")]
    assert readers.master(spark, str(tmp_path / "none.json"), "suppliers", "supplier_id string").count() == 0
    company = spark.createDataFrame([("C", "N", "V", [("U", "n", None, [("L", "ln", "addr")])])], readers.ORG)
    assert readers.organisation(company).first().vat_id == "V"
    ocr = spark.createDataFrame([("a", "90"), (" ", "90"), ("b", "12"), ("c", "x")], "text string, conf string")
    assert [r.text for r in readers.kept_words(ocr).collect()] == ["a"]
    assert spark.createDataFrame([('say {"a": 1} ok',), ("none",)], "t string").select(readers.salvaged_json(F.col("t"), "a int")["a"]).collect()[0][0] == 1
    readers.write_files(spark.createDataFrame([("d/x.pdf", 1), ("e/x.pdf", 2)], "file string, n int"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).count() == 2


def test_report_nests_by_file(spark):
    results = spark.createDataFrame([("f", 1, "reconciled_as_read"), ("f", 2, "unreconciled")], "file string, payable int, status string")
    assert len(report.by_file(results, "file").first().payables) == 2
    assert report.totals(results.limit(0)).first().book_rate == 0.0


def test_stream_books_new_payables_once(spark, tmp_path):
    lines = spark.createDataFrame([(1, 1.0, 100.0, None, 20.0, "GOODS", 100.0)], LINE)
    (tmp_path / "lines").mkdir()
    lines.write.mode("append").parquet(str(tmp_path / "lines"))
    out = str(tmp_path / "out")
    for _ in range(2):
        folder.book_new_lines(spark, str(tmp_path / "lines"), out, str(tmp_path / "state")).awaitTermination(60)
    assert [(r.payable, float(r.line_base), float(r.line_tax)) for r in spark.read.parquet(out).collect()] == [(1, 100.0, 20.0)]


def test_column_anchors_over_whole_texts(spark, sf_dir):
    kinds = list(dict.fromkeys(k for k, _ in pages._HEADS))
    rows, want, headed = {}, {}, set()
    for r in layout.row_clusters(pages.words(spark, sf_dir)).select("page", "row_ix", "x0", "word_ix", F.btrim(fold(F.col("text")), F.lit(".:%()")).alias("f")).collect():
        rows.setdefault((r.page, r.row_ix), []).append((r.x0, r.word_ix, r.f))
    for (page, row), own in sorted(rows.items()):
        own.sort()
        found, claimed = {}, set()
        for n in (3, 2, 1):
            for at in range(len(own) - n + 1):
                phrase = " ".join(w[2] for w in own[at : at + n]).strip()
                kind = next((k for k in kinds if k not in found and (k, phrase) in pages._HEADS), None)
                if kind and not claimed & set(range(at, at + n)):
                    found[kind] = own[at][0]
                    claimed |= set(range(at, at + n))
        if found:
            heads = len(found) >= 3 or {"quantity", "unit_price"} <= set(found) or {"description", "total"} <= set(found)
            want[page, row] = (",".join(sorted(found)), min(found.values()), heads and page not in headed)
            headed |= {page} if heads else set()
    got = {(r.page, r.row_ix): (r.kinds, r.x0, r.header) for r in pages.column_anchors(spark, sf_dir).collect()}
    assert got == want and headed


def test_table_header_rules(spark):
    found = [(1, 4, "quantity"), (1, 5, "description"), (1, 5, "total"), (1, 7, "quantity"), (1, 7, "unit_price"), (2, 9, "unit_price"), (2, 9, "quantity"), (3, 3, "tax"), (3, 3, "uom"), (3, 8, "tax"), (3, 8, "uom"), (3, 8, "total"), (4, 0, "total"), (4, 0, "tax")]
    heads = layout.table_header(spark.createDataFrame(found, "page long, row_ix long, kind string")).collect()
    assert {(r.page, r.row_ix) for r in heads} == {(1, 5), (2, 9), (3, 8)}
