import zlib
from collections import defaultdict

from tallyframe.llm import kdshard
from tallyframe.llm.queries_native import op5_kd_shards


def check(rows, shards, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total = sum(r.size for r in rows)
    assert all(abs(sum(r.size for r in by[s]) - total / shards) <= slack for s in range(shards))


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op5_kd_shards(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    largest = max(r.size for r in rows)
    check(rows, 24, 4 * largest)
    # copies share a shard unless their group is heavy
    group, shards = defaultdict(int), defaultdict(set)
    for r in rows:
        group[texts[r.doc_id]] += r.size
        shards[texts[r.doc_id]].add(r.shard)
    part = sum(r.size for r in rows) / (24 * kdshard.PIECES)
    assert all(len(shards[t]) == 1 for t, w in group.items() if w <= part)


def test_copies_stay_together(spark):
    df = spark.range(20000).selectExpr("id AS doc_id", "concat('t', if(id % 3 = 0, 0, id % 4000)) AS text", "concat('s', id % 7) AS source", "cast(id % 11 AS double) AS q")
    df = df.withColumn("lang", df["source"])
    rows = kdshard.shard(df, shards=6, dims=("source", "lang", "q")).collect()
    check(rows, 6, sum(r.size for r in rows) / 6 * 0.01)
    texts = {r.doc_id: r.text for r in df.collect()}
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    hot = shards.pop("t0")
    assert 2 <= len(hot) <= 6 and all(len(s) == 1 for s in shards.values())


def test_weighted_median_of_a_hot_value(spark):
    df = spark.range(30000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source", "1 AS n_chars")
    rows = kdshard.shard(df, shards=7, dims=("source", "n_chars")).collect()
    assert len(rows) == 30000
    total = sum(r.size for r in rows)
    check(rows, 7, total / 7 * 0.005 + 58)


def test_cases(spark):
    rows = [(None, None, None, None), (1, None, "a", 1.5), (1, None, "a", 1.5), (2, "", "b", float("nan")), (3, "é" * 5000, "c", -4.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, q double").selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS node", "5 AS dims", "6 AS tie", "7 AS same", "8 AS w")
    got = kdshard.shard(df, shards=3, dims=("source", "q", "doc_id")).collect()
    assert len(got) == 5 and sorted((r.size, r.crc) for r in got)[:4] == [(8, 0)] * 4
    assert kdshard.shard(df.limit(0), shards=3, dims=("source", "q")).collect() == []
    assert {r.shard for r in kdshard.shard(df, target_bytes=10**9, dims=("q",)).collect()} == {0}


def test_write(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    kdshard.write_shards(df, str(tmp_path / "out"), shards=4, dims=("doc_id",))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
