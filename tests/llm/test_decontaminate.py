import random
import re

from tallyframe.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(text, items, window=13):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            part = w[i : i + window]
            for at in range(len(doc) - len(part) + 1):
                if doc[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(doc)


def cases():
    rnd = random.Random(5)
    vocabulary = ["of", "the", "A", "bé", "x1", "Q", "zz"]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 3, 7, 13, 14, 30]))) for i in range(25)] + [(100, None), (101, ""), (102, "..."), (7, "of the A")]
    docs = [(i, text(rnd.choice([0, 1, 5, 40])) + rnd.choice(items)[1:][0].__str__() + text(rnd.choice([0, 30]))) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "!?"), (3, docs[3][1]), (103, "of the " * 2000)], items


def check(spark, **options):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'w' AS n_words", "7 AS spans", "doc_id AS item_id")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    rows = decontaminate.judged(d, b, **options).collect()
    assert len(rows) == len(docs)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, t)
    for r in rows:
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == brute(texts[r.doc_id], items), r.doc_id


def test_against_brute_force(spark):
    check(spark)


def test_blocks_give_the_same(spark):
    check(spark, block_windows=40)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.judged(docs, none).collect()] == [False]
    assert decontaminate.judged(docs.limit(0), none).collect() == []


def test_filter_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en"), (2, "p q", None)], "doc_id long, text string, lang string").selectExpr("7 AS n_hit", "*", "'w' AS n_words", "8 AS spans", "9 AS contaminated", "'i' AS item_ids")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(7, 2, "p q", None, "w", 8, 9, "i")]


def test_share_and_bytes(spark):
    docs = spark.createDataFrame([(n, "b c " + "x " * n) for n in range(1, 9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "B-c")], "item_id long, text string")
    rows = decontaminate.judged(docs, items, share=0.3).collect()
    assert {r.doc_id for r in rows if r.contaminated} == {n for n in range(1, 9) if 10 * 2 >= 3 * (n + 2)}
    assert all([(s.start, s.stop, s.begin, s.end) for s in r.spans] == [(0, 2, 0, 3)] for r in rows)
