import hashlib
import random
import re
import zlib

import regex

from tallyframe.llm import spotsigs
from tallyframe.llm.queries_native import op10_spotsigs

STOP = set(spotsigs.COMMON.split())


def brute(text, chain=2):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    out = set()
    for i, w in [(-1, "^"), *((i, w) for i, w in enumerate(words) if w in STOP and (i + 1 == len(words) or words[i + 1] not in STOP))]:
        own = words[i + 1 :]
        content = [x for x in own if x not in STOP][:chain]
        if content:
            out.add(zlib.crc32(" ".join([w, *content]).encode()))
    return out


def jaccard(x, y):
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def parts(fingerprint):
    return {int(x, 16) for x in re.findall(".{8}", fingerprint)}


def check(rows, got):
    order = sorted(rows)
    for r in got:
        i = [k for k, _ in order].index(r.doc_id)
        text, after = order[i][1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert parts(r.fingerprint) == brute(text) and parts(r.edited_fingerprint) == brute(edited), text[:200]
        assert abs(r.near_edited - jaccard(brute(text), brute(edited))) < 1e-12
        assert abs(r.near_next - jaccard(brute(text), brute(after))) < 1e-12


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op10_spotsigs(spark, sf_dir).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_cases(spark, tmp_path):
    rows = [(5, None), (1, ""), (9, "the"), (7, "The of cat"), (-3, "a dog!! and the cat's of 𝒳éü"), (8, "cat | the ^ dog of it cat"), (2, "word " * 9000), (3, "the of " * 20000 + "cat"), (4, "x" * 50000)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS signs").write.parquet(str(tmp_path / "documents.parquet"))
    check(rows, op10_spotsigs(spark, str(tmp_path)).collect())


def test_many_ranges(spark):
    sizes = spark.range(1000).selectExpr("id * 7 AS k", "id AS chars")
    got = {r.before: r.k for r in spotsigs.followers(sizes, rows_each=30).collect()}
    assert got == {7 * i: 7 * ((i + 1) % 1000) for i in range(1000)}


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "the x y"), (1, "of p q"), (1, "of b c"), (1, "of p q"), (2, "and z")], "doc_id long, text string")
    got = sorted((r.id or -9, r.edited) for r in spotsigs.fingerprints(df).collect())
    assert got == [(-9, "the of "), (1, "of and"), (1, "of and"), (1, "of and"), (2, "and th")] or len(got) == 5
    assert spotsigs.fingerprints(df.limit(0)).collect() == []


def test_sizes_are_shuffled_for_repeated_ids_alone(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(spotsigs, "written", lambda df, name: seen.append(df) or df)
    rows = [(None, "the x y"), (4, None), (1, "of p q r s"), (-2, "and z")]
    for more, shuffled in (([], False), ([(1, "of b"), (4, "the x")], True), ([(None, "of long words")], True)):
        given = rows + more
        got = spotsigs.fingerprints(spark.createDataFrame(given, "doc_id long, text string")).collect()
        assert ("Exchange" in seen[-1]._jdf.queryExecution().toString()) == shuffled
        sizes = {}
        for k, text in given:
            sizes[-3 if k is None else k] = max(sizes.get(-3 if k is None else k, 0), len(text or ""))
        assert sorted(map(tuple, seen[-1].collect())) == sorted(sizes.items())
        order, least = sorted(sizes), {}
        for k, text in given:
            k = -3 if k is None else k
            least[k] = min(least.get(k, text or ""), text or "")
        want = []
        for k, text in given:
            text, after = text or "", least[order[(order.index(-3 if k is None else k) + 1) % len(order)]]
            want.append((-3 if k is None else k, text, text[: len(text) - len(text) // 2] + after[: len(text) // 2]))
        assert sorted((-3 if r.id is None else r.id, r.text, r.edited) for r in got) == sorted(want)


def test_near_pairs(spark):
    base = " ".join(f"the w{i} v{i}" for i in range(60))
    rows = [(1, base), (2, base), (3, base.replace("w5 ", "zz ")), (4, " ".join(f"of a{i} b{i}" for i in range(60))), (5, None)]
    got = {(r.id, r.near) for r in spotsigs.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, 1), (3, 1)}


def test_near_pairs_by_all_pairs(spark):
    rnd = random.Random(2)
    rows = []
    for f in range(3):
        base = [f"the f{f}w{i} v{i}" for i in range(40)]
        for i in range(30):
            words = base[: rnd.randrange(34, 41)]
            for k in rnd.sample(range(len(words)), rnd.choice([1, 2, 4, 6])):
                words[k] = f"of e{rnd.randrange(9)} g{k}"
            rows.append((len(rows), " ".join(words)))
    sets = {i: brute(t) for i, t in rows}
    assert len({frozenset(x) for x in sets.values()}) == len(rows)
    want = {(i, j) for i in sets for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (7, 256):
        got = [(r.id, r.near) for r in spotsigs.near_pairs(df, most=most).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 20
