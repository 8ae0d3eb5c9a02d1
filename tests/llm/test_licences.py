import re

import pytest

from tallyframe.llm import licences
from tallyframe.llm.queries_text import op6_licence_scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOW))
    hits = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


def test_expressions():
    f = licences.alternatives
    assert f("MIT") == {frozenset(["mit"])}
    assert f("MIT OR Apache-2.0 AND ISC") == {frozenset(["mit"]), frozenset(["apache-2", "isc"])}
    assert f("(MIT OR Apache-2.0) AND ISC") == {frozenset(["mit", "isc"]), frozenset(["apache-2", "isc"])}
    assert f("GPL-2.0 WITH Classpath-exception-2.0 OR MIT") == {frozenset(["gpl-2-with-classpath-exception-2.0"]), frozenset(["mit"])}
    for bad in ("", "OR MIT", "(MIT", "MIT)", "MIT AND"):
        with pytest.raises(licences.ExpressionError):
            f(bad)


def test_scan_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "..."), (4, "Released under the MIT License, under the MIT license"),
        (5, "x\n// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC\ny"), (6, "cc by nc cc by nc"), (6, "cc by nc cc by nc"),
        (7, "SPDX-License-Identifier: MIT AND\n"), (8, "Ünder the mit license"), (9, "w " * 300000 + "Apache License, Version 2.0"),
        (10, "SPDX-License-Identifier:"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS score", "1 AS places")
    got = {r.doc_id: r for r in licences.scan_licences(df).collect()}
    assert len(got) == 10
    assert got[1].n_words == 0 and got[1].labels == [] and got[1].score == 0
    assert [p.word for p in got[4].places] == [1, 5] and got[4].labels == ["mit"]
    assert got[5].labels == ["apache-2", "isc", "mit"] and got[5].choices == [["apache-2+isc", "isc+mit"]] and got[5].score == 0.9
    assert [p.word for p in got[6].places] == [0, 3]
    assert got[7].labels == ["mit"] and got[7].choices == []
    assert got[8].labels == []
    assert [p.word for p in got[9].places] == [300000]
    assert got[10].labels == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert licences.scan_licences(df).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_licence_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_long_expressions():
    names = [f"licenseref-{i:03}" for i in range(60)]
    found = licences.Scanner().scan(("// SPDX-License-Identifier: (" + " AND ".join(names) + ") OR MIT\nISC").encode())
    assert found.labels == {*names, "mit"} and found.tagged and len(found.choices[0]) == 2
    pairs = [(f"a{i}", f"b{i}") for i in range(9)]
    many = " AND ".join(f"({a} OR {b})" for a, b in pairs) + " AND GPL-2.0 WITH e-1"
    found = licences.Scanner().scan(("SPDX-License-Identifier: " + many).encode())
    assert found.labels == {x for p in pairs for x in p} | {"gpl-2-with-e-1"} and found.tagged and found.score() == 0.9
    for e in ("MIT", "MIT OR Apache-2.0 AND ISC", "GPL-2.0 WITH c-2.0 OR MIT", "(MIT OR x) WITH y AND z+"):
        assert licences.named(e) == {x for a in licences.alternatives(e) for x in a}
