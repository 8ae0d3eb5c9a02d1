import random
import zlib

import numpy as np

from tallyframe.llm import labelled, mil, zstdtox
from tallyframe.llm.queries_scores import op7_mil_quality, op9_zstd_toxicity

SF = "/root/testdata/sf0.1"


def held_out_figures(spark, query, label, threshold):
    want = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    test = [(want[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in want]
    hit = sum(y and p for y, p in test) / sum(y for y, _ in test)
    false = sum(p and not y for y, p in test) / sum(not y for y, _ in test)
    return hit, false


def test_quality_on_held_out_documents(spark):
    hit, false = held_out_figures(spark, op7_mil_quality, "quality", 0.7)
    assert hit >= 0.97 and false <= 0.1


def test_toxicity_on_held_out_documents(spark):
    hit, false = held_out_figures(spark, op9_zstd_toxicity, "toxic", 0.3)
    assert hit >= 0.65 and false <= 0.08


def test_gradient():
    r = np.random.default_rng(2)
    x, doc, y = r.normal(size=(9, 4)), np.array([0, 0, 0, 1, 1, 2, 3, 3, 3]), np.array([1.0, 0, 1, 0])
    m = mil.Model(4)
    first, of = np.searchsorted(doc, np.arange(4)), doc

    def loss():
        p = mil._sigmoid(m._forward(x, first, of)["y"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = m._gradient(x, first, of, y, 0.0)
    for k in m.p:
        at = (0,) * m.p[k].ndim
        m.p[k][at] += 1e-6
        high = loss()
        m.p[k][at] -= 2e-6
        assert abs((high - loss()) / 2e-6 - g[k][at]) < 1e-6
        m.p[k][at] += 1e-6


def test_attention_weighs_every_passage():
    texts = [b"", b"a b", b" ".join(b"w%d" % i for i in range(500))]
    doc, x = mil.passages(texts)
    assert np.bincount(doc).tolist() == [1, 1, 10] and np.isfinite(x).all()
    _, a = mil.Model(x.shape[1]).score(doc, x, 3)
    assert np.allclose(np.bincount(doc, a), 1)


def cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "é" * 3000), (5, "word " * 60000), (5, "word " * 60000)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS score", "1 AS attention", "2 AS other")


def test_cases(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice("abcdef") * 3 + ("!!" if i % 2 else "") for _ in range(80)).encode(), i % 2) for i in range(40)]
    df = cases(spark)
    for model, score in ((mil.fitted(rows, steps=30), mil.score_quality), (zstdtox.fitted(rows), zstdtox.score_toxicity), (mil.fitted([]), mil.score_quality), (zstdtox.fitted([]), zstdtox.score_toxicity)):
        got = score(df, model).collect()
        assert len(got) == 6 and all(0 <= x.score <= 1 and x.other == 2 for x in got)
        assert got[4].score == got[5].score
        assert score(df.limit(0), model).collect() == []


def test_sample_leaves_the_held_out_fold(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(200).selectExpr("id AS doc_id", "if(id = 7, null, cast(id % 2 as int)) AS toxic")
    got = labelled.sample(docs, labels.union(labels), "toxic", 1000)
    want = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2 and i != 7]
    assert [g[0] for g in got] == want and got[0][1] == b"t%d" % got[0][0]
    assert len(labelled.sample(docs, labels, "toxic", 10)) == 10
