import random
from collections import defaultdict

import numpy as np

from tallyframe.llm import dartminhash
from tallyframe.llm.bytewords import fold_words
from tallyframe.llm.queries_text import op8_dart_minhash


def shingles(text):
    w = fold_words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Classes by all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(t or "", (i, shingles(t)))
    texts = list(sets)
    up = {t: t for t in texts}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t

    by = defaultdict(list)
    for t in texts:
        for s in sets[t][1]:
            by[s].append(t)
    done = set()
    for own in by.values():
        for k, a in enumerate(own):
            for b in own[:k]:
                if (a, b) not in done:
                    done.add((a, b))
                    x, y = sets[a][1], sets[b][1]
                    if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                        up[root(a)] = root(b)
    least = {}
    for i, t in rows:
        r = root(t or "")
        least[r] = min(least.get(r, i), i)
    return {i: least[root(t or "")] for i, t in rows}


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def test_signatures_estimate_weighted_likeness():
    rnd = np.random.default_rng(1)
    h = rnd.integers(1, 2**63, 300, np.uint64)
    a, b = rnd.choice([1.0, 2.0, 3.5], 300), rnd.choice([1.0, 2.0, 3.5], 300)
    b[:60] = 0
    use = b > 0
    doc = np.concatenate([np.zeros(300, int), np.ones(use.sum(), int)])
    sig = dartminhash.signatures(doc, np.concatenate([h, h[use]]), np.concatenate([a, b[use]]), 2, 2048)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_against_all_pairs(spark):
    rnd = random.Random(7)
    rows = [(0, None), (1, ""), (2, "!!"), (3, "one"), (4, "One!"), (5, "a b c d"), (6, "a b c d"), (6, "a b c d")]
    for _ in range(12):
        base = [rnd.choice("abcdefghij") * rnd.randint(1, 3) + str(rnd.randrange(500)) for _ in range(rnd.choice([6, 30, 200, 1500]))]
        for _ in range(rnd.randint(1, 9)):
            rows.append((len(rows) + 10, edited(rnd, base, rnd.choice([0, 0, 1, 2, len(base) // 60, len(base) // 25]))))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS bands", "3 AS class_id")
    got = dartminhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    kept = dartminhash.keep_one(df)
    assert kept.columns == df.columns and sorted({r.doc_id for r in kept.collect()}) == sorted(set(brute(rows).values()))


def test_large_group_of_near_copies(spark):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(9999)}" for _ in range(200)]
    rows = [(i, edited(rnd, base, 2)) for i in range(400)] + [(1000 + i, " ".join(base[:20] + [f"u{i}_{j}" for j in range(150)])) for i in range(100)]
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(400)) and all(got[1000 + i] == 1000 + i for i in range(100))


def test_empty(spark):
    assert dartminhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {r.doc_id: r.class_id for r in op8_dart_minhash(spark, sf_dir).collect()} == brute(rows)


def family(rnd, n, edits, near):
    """Texts of one template with the given edits each; texts of middle ids have one edit, so that they are near each other alone."""
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    places = lambda k: rnd.sample(range(5, 195, 8), k)

    def made(k):
        words = list(base)
        for at in places(k):
            words[at] = f"e{rnd.randrange(10**9)}"
        return " ".join(words)

    rows = [(i * 10, made(edits)) for i in range(n)]
    return rows + [(n // 2 * 10 + 1 + 3 * i, made(1)) for i in range(near)]


def test_pairs_of_large_buckets_that_no_head_links(spark):
    rnd = random.Random(4)
    rows = family(rnd, 300, 6, 2) + [(-5000 + i, t) for i, t in family(rnd, 120, 7, 0)]
    rows += [(10**6, rows[-1][1] + " w w w w w w w w w w w w")]
    want = brute(rows)
    assert len(set(want.values())) == len(rows) - 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in dartminhash.near_duplicates(df, small=8).collect()} == want


def test_block_comparison_by_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(f, f * 1000 + i, sorted(rnd.sample(range(f * 100, f * 100 + 45), rnd.randrange(28, 45)))) for f in range(3) for i in range(60)]
    classes = {i: i - i % 4 if i % 1000 < 16 else i if i % 3 else f * 1000 + 999 for f, i, _ in rows}
    texts = spark.createDataFrame([(f, classes[i], i, len(s)) for f, i, s in rows], "family long, class long, id long, n long")
    sets = spark.createDataFrame([(i, s) for _, i, s in rows], "id long, shingles array<long>")

    def joined(links):
        up = {c: c for c in classes.values()}
        for a, b in links:
            x, y = up[classes[a]], up[classes[b]]
            up = {c: x if r == y else r for c, r in up.items()}
        return {frozenset(c for c in up if up[c] == r) for r in up.values()}

    near = [(i, j) for f, i, s in rows for g, j, t in rows if f == g and i < j and len(set(s) & set(t)) >= 0.8 * len(set(s) | set(t)) - 1e-9]
    for most in (7, 1000):
        got = [(r.a, r.b) for r in dartminhash._family_links(texts, sets, 0.8, most).collect()]
        assert {tuple(sorted(x)) for x in got} <= set(near) and joined(got) == joined(near)
    assert 3 < len(joined(near)) < len(set(classes.values()))


def test_repeated_text_is_near_itself(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(60):
        words = [f"w{rnd.randrange(10**9)}" for _ in range(150)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words * (2 + i % 15)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert all(want[i] == i - i % 2 for i in want)
    assert {r.doc_id: r.class_id for r in dartminhash.near_duplicates(df).collect()} == want


def test_null_and_repeated_ids_by_rows(spark):
    rnd = random.Random(13)
    base = [f"w{i}" for i in range(200)]
    near, far = edited(rnd, base, 2), " ".join(f"v{i}" for i in range(30))
    rows = [(3, " ".join(base)), (3, " ".join(base)), (3, near), (4, far), (3, "other words"), (None, "clean text"), (5, "clean text"), (None, "more text"), (None, "more text"), (None, None)]
    df = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], "doc_id long, text string, uid int, of string")
    kept = dartminhash.keep_one(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(t in (" ".join(base), near) for _, t in got) == 1
    rest = [x for x in got if x[1] not in (" ".join(base), near)]
    assert sorted(rest, key=str) == sorted([(4, far), (3, "other words"), (None, "clean text"), (None, "more text"), (None, None)], key=str)
    classes = sorted(((r.doc_id, r.class_id) for r in dartminhash.near_duplicates(df).collect()), key=str)
    assert classes == sorted([(3, 3)] * 4 + [(4, 4), (None, 5), (5, 5), (None, None), (None, None), (None, None)], key=str)
