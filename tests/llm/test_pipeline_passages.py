"""Stages 3 and 4 together: repeated passages go whole, documents that came in contaminated go all the same."""

import random

import pytest

import corpus_pipeline
from tests.llm import test_suffixdedup

R = random.Random(5)


def prose(n):
    return " ".join("".join(R.choice("abcdefghijklmnop") for _ in range(R.randint(3, 9))) for _ in range(n))


PASSAGE, REPEATED = prose(60), prose(70)
CONTAMINATED, CLEAN = prose(150) + " " + PASSAGE + " " + prose(90), prose(120) + " " + REPEATED
ROWS = [
    (1, "en", prose(80) + " " + PASSAGE + " " + prose(200)),
    (2, "en", prose(200) + " " + PASSAGE + " " + prose(130)),
    (3, "en", prose(100) + " " + REPEATED),
    (4, "en", prose(60) + " " + REPEATED + " " + prose(60)),
    (5, "en", None),
    (6, "en", prose(3000) + " " + PASSAGE),
    (7, "en", CONTAMINATED),
    (7, "en", CLEAN),
    (7, "en", "short"),
    (None, None, prose(90) + " " + PASSAGE),
    (None, None, prose(50)),
    (8, "en", prose(150) + " " + PASSAGE + " " + prose(9)),
    (8, "de", prose(40)),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("passages"))
    spark.createDataFrame([(i, t, g, None if t is None else len(t)) for i, g, t in ROWS], "doc_id long, text string, lang string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, prose(30))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def cut(spark, folder):
    return corpus_pipeline.repeated_passages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).cache()


def test_repeated_passages_go_from_contaminated_documents(cut):
    want = sorted((i, kept.decode()) for (i, _), (_, _, kept) in test_suffixdedup.brute([(i or 0, t) for i, _, t in ROWS], 100).items())
    got = sorted((r.doc_id or 0, r.text or "") for r in cut.collect())
    assert got == want
    assert sum(PASSAGE in t for _, _, t in ROWS if t) == 6 and sum(PASSAGE[30:-30] in t for _, t in got) == 1


def test_documents_go_that_came_in_contaminated(spark, folder, cut):
    got = corpus_pipeline.contamination(spark, cut, folder)
    assert got.columns == cut.columns
    kept = sorted((r.doc_id or 0, r.lang or "", len(r.text or "")) for r in got.collect())
    texts = {(i or 0, g or "", t) for i, g, t in ROWS}
    assert [(i, g) for i, g, _ in kept] == sorted((i, g) for i, g, t in texts if (t or "").count(PASSAGE) == 0 or i == 6)
    assert {"short", ROWS[10][2], ROWS[12][2]} <= {r.text for r in got.collect()}


def test_rows_that_came_from_elsewhere_are_judged_as_they_are(spark, folder):
    docs = spark.createDataFrame([(1, "alpha beta", "fr", 10), (99, PASSAGE, "en", 9), (98, "gamma", "en", 5)], "doc_id long, text string, lang string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.contamination(spark, docs, folder).collect()) == [1, 98]
