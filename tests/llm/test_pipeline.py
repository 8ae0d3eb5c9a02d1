import random

import pytest

import corpus_pipeline
from tallyframe.llm import bpe, decontaminate
from tallyframe.llm.queries_text import tokenizer_path
from tests.llm import test_dartminhash, test_decontaminate, test_suffixdedup

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "contamination", "tokens"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_keeps_the_good(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {i for i, _ in rows(stages[1])}
    good = [i for i, q in labels.items() if q]
    bad = [i for i, q in labels.items() if not q]
    assert sum(i in kept for i in good) / len(good) > 0.95 and sum(i in kept for i in bad) / len(bad) < 0.15


def test_near_duplicates_by_all_pairs(stages):
    want = test_dartminhash.brute(rows(stages[1]))
    assert sorted(i for i, _ in rows(stages[2])) == sorted(set(want.values()))


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def spared(text, items, window=13):
    """The bytes of benchmark windows, one more on either side."""
    places = [m.span() for m in test_decontaminate.WORD.finditer(text.translate(test_decontaminate.LOW))]
    doc, stay = test_decontaminate.words(text), set()
    for _, body in items:
        w = test_decontaminate.words(body)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            part = w[i : i + window]
            for at in range(len(doc) - len(part) + 1):
                if doc[at] == part[0] and doc[at : at + len(part)] == part:
                    a, z = (len(text[:c].encode()) for c in (places[at][0], places[at + len(part) - 1][1]))
                    stay.update(range(a - 1, z + 1))
    return stay


def test_repeated_passages_by_brute_force(stages, items):
    want = {}
    for (i, text), (_, spans, kept) in test_suffixdedup.brute(rows(stages[2]), 100).items():
        if spans and test_decontaminate.brute(text, items)[3]:
            stay = spared(text, items)
            gone = {p for a, z in spans for p in range(a, z)} - stay
            kept = bytes(b for p, b in enumerate(text.encode()) if p not in gone)
        want[i] = kept.decode("utf-8", "ignore")
    assert dict(rows(stages[3])) == want
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_planted_windows_of_the_input_go(spark, stages):
    judged = decontaminate.judged(stages[2].select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    flagged = {r.doc_id for r in judged.collect() if r.contaminated}
    assert flagged and not flagged & {i for i, _ in rows(stages[4])}


def test_contamination_by_brute_force(stages, items):
    kept = {i for i, _ in rows(stages[4])}
    before = rows(stages[3])
    chosen = [x for x in before if x[0] not in kept] + random.Random(3).sample(before, 25)
    for i, text in chosen:
        assert (i not in kept) == test_decontaminate.brute(text, items)[3]


def test_tokens_by_the_library(stages):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    texts = dict(rows(stages[4]))
    got = stages[5].collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        decoder = bpe.TextDecoder(bpe.load(tokenizer_path()).m)
        assert r.decoded == decoder.feed(r.ids) + decoder.finish()


def test_run(spark, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in stages[5].collect())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_extra_columns_pass(spark):
    docs = spark.createDataFrame([(1, "alpha beta", "en", "s", 10, 5, None), (2, None, None, None, None, 6, "x"), (None, "gamma", None, None, 5, 7, "y")], "doc_id long, text string, lang string, source string, n_chars long, score int, bands string")
    docs = docs.selectExpr("*", "1 AS uid", "2 AS kept", "3 AS n_hit", "4 AS ids", "5 AS decoded", "6 AS n_words", "7 AS __row")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name == "tokens":
            assert sorted(r.decoded for r in got.collect()) == ["", "alpha beta ", "gamma "]
            continue
        assert got.columns == docs.columns
        if name != "quality":
            assert {r.score for r in got.collect()} == {5, 6, 7}, name
