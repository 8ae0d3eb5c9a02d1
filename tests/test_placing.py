"""Cells below a page's first row in one pass: against rows, bounds and cells told one after another."""

import random

from pyspark.sql import functions as F

from tallyframe.operators import layout
from tallyframe.plans import pages

WORD = "page long, word_ix long, text string, x0 double, x1 double, top double, bottom double, head string"


def test_cells_in_one_pass_are_those_of_the_steps(spark):
    rng = random.Random(4)
    given = []
    for p in range(120):  # columns don't overlap: the steps leave open which of several comes first
        heads = rng.sample(["a", "b", "c", "d"], rng.randint(0, 4))
        x = 0.0
        for k in heads:
            x += rng.choice([30.0, 70.0, 120.0])
            given.append((p, len(given), k.upper(), x, x + rng.choice([5.0, 25.0]), 0.0, 10.0, k))
        for _ in range(rng.randint(0, 60)):
            x, y = rng.choice([0.0, 40.0, 90.0, rng.random() * 500 - 20]), rng.choice([0.5, 12.0, 12.5, 24.0, 36.0])
            given.append((p, len(given) if p % 9 == 0 else rng.choice([len(given), 1]), rng.choice(["w", "vv", "ü", ""]), x, x + 20, y, y + 10, None))
            if p % 9 == 0:  # nulls, NaN and infinities among the words
                own = [p, len(given), *given[-1][2:]]
                own[rng.choice([2, 3, 4, 5, 6])] = None
                given.append(tuple(own))
                own = [p, len(given), *given[-2][2:]]
                own[rng.choice([3, 4, 5, 6])] = rng.choice([float("nan"), float("inf")])
                given.append(tuple(own))
    rng.shuffle(given)
    words = spark.createDataFrame(given, WORD)
    placed = layout.row_clusters(words).cache()
    bounds = layout.column_bounds(placed.where("row_ix = 0 AND head IS NOT NULL").withColumnRenamed("head", "kind"))
    want = layout.cells(placed.where("row_ix > 0").drop("head"), bounds)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = layout.headed_cells(words).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) > 100 and sorted(map(tuple, got)) == sorted(map(tuple, want.select("page", "row_ix", "kind", "text").collect()))


def test_rows_of_words_with_nulls_are_those_of_the_windows(spark):
    rng = random.Random(2)
    odd = [None, float("nan"), float("inf")]
    given = [(p, i, f"w{i}", float(rng.randint(0, 9)), 9.0, rng.choice([0.0, 8.0, 20.0, rng.choice(odd)]), rng.choice([10.0, 18.0, 30.0]), "k" if i % 7 == 0 else None) for p in range(40) for i in range(rng.randint(1, 25))]
    words = spark.createDataFrame(given, WORD)
    rows = layout.row_clusters(words)
    heads = rows.where("row_ix = 0 AND head IS NOT NULL").select("page", F.col("head").alias("kind"), "x0", "x1")
    alone = heads.join(heads.groupBy("page").count().where("count = 1"), "page", "left_semi")
    want = layout.cells(rows.where("row_ix > 0").drop("head"), layout.column_bounds(alone))
    got = layout.headed_cells(words).join(alone.select("page"), "page", "left_semi")
    assert want.count() > 5 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("page", "row_ix", "kind", "text").collect()))


def test_bounds_and_cells_ask_for_no_join_or_window(spark):
    plan = pages.column_bounds_cells(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("Exchange") == 2
