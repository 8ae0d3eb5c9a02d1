import hashlib
import random

import pytest

from tallyframe.llm import suffixdedup
from tallyframe.llm.queries_text import op3_suffix_dedup


def brute(rows, length):
    """rows in order; {(id, text): (n_bytes, spans, kept)}"""
    seen, out = set(), {}
    for i, text in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0], hashlib.md5(x[1].encode()).hexdigest())):
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans, kept = [], bytes(b for b, g in zip(raw, gone) if not g)
        for p, g in enumerate(gone):
            if g and (not p or not gone[p - 1]):
                spans.append([p, p])
            if g:
                spans[-1][1] = p + 1
        out[i, text] = (len(raw), [tuple(x) for x in spans], kept)
    return out


def check(spark, rows, length, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS uid", "'k' AS kept", "2 AS removed", "3 AS runs", "4 AS spared", "5 AS __row")
    got = suffixdedup.remaining(df, length=length, **options).collect()
    want = brute(rows, length)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) == want[r.doc_id, r.text or ""], r.doc_id


def texts(seed, n):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(k) for k in (8, 20, 40, 90, 300)]
    rows = []
    for i in range(n):
        t = " ".join(rnd.choice([prose(rnd.choice([1, 9, 40])), rnd.choice(shared), rnd.choice(shared)[rnd.randint(0, 30) :]]) for _ in range(rnd.randint(1, 5)))
        if i % 7 == 3:
            t = rows[-1][1]
        if i % 11 == 5:
            k = rnd.randrange(len(t) + 1)
            t = rows[-2][1][:k] + "X" + rows[-2][1][k:]
        rows.append((i * 3 % (n * 3 + 1), t))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, texts(seed, 120) + [(1000, None), (1001, ""), (1002, "ab" * 400), (1003, "é" * 300), (1004, "ab" * 60)], 100)


def test_repeated_ids_and_rows(spark):
    rows = texts(3, 30)
    check(spark, rows + [rows[4], rows[4], (rows[5][0], rows[6][1])], 100)


def test_stream_goes_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, texts(4, 60), 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("length", [1, 9, 20, 300, 500])
def test_other_lengths(spark, length):
    check(spark, texts(6, 40) + [(900, "ab" * 900), (901, "xy" + "ab" * 700)], length)


def test_too_long(spark):
    with pytest.raises(ValueError):
        suffixdedup.remaining(spark.createDataFrame([(1, "a")], "doc_id long, text string"), length=5000)


def test_spared_bytes_stay(spark):
    text = "".join(f"{k}é " for k in range(120))
    df = spark.createDataFrame([(1, text), (2, text), (3, text[:200])], "doc_id long, text string")
    spare = lambda rows: rows.selectExpr("*", "if(uid = 2, array(named_struct('start', -1L, 'stop', 5L), named_struct('start', 150L, 'stop', 180L)), null) AS spared")
    raw = text.encode()
    got = {r.doc_id: (bytes(r.kept), [tuple(x) for x in r.removed]) for r in suffixdedup.remaining(df, spare=spare).collect()}
    assert got == {1: (raw, []), 2: (raw[:5] + raw[150:180], [(5, 150), (180, len(raw))]), 3: (b"", [(0, len(text[:200].encode()))])}


def test_empty(spark):
    assert suffixdedup.remaining(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_dedup_keeps_columns(spark):
    text = "".join(f"{k}é " for k in range(80))
    df = spark.createDataFrame([(1, text, "en"), (2, text, None), (3, None, "de")], "doc_id long, text string, lang string").selectExpr("1 AS uid", "*", "2 AS kept", "3 AS removed", "4 AS n_bytes", "5 AS id")
    got = suffixdedup.dedup(df)
    assert {tuple(r)[-4:] for r in got.collect()} == {(2, 3, 4, 5)}
    assert got.columns == df.columns and {r.doc_id: r.text for r in got.collect()} == {1: text, 2: "", 3: None}


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {i: v for (i, _), v in brute(rows, 100).items()}
    for r in op3_suffix_dedup(spark, sf_dir).collect():
        n, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, sum(z - a for a, z in spans), len(spans), hashlib.sha256(kept).hexdigest())
