"""What the plans of the larger steps do once."""

from tallyframe.operators import layout, reconcile

WORD = "page int, word_ix long, text string, x0 double, x1 double, top double, bottom double"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def placed(spark, tops):
    return spark.createDataFrame([(1, i, "the", i * 30.0, i * 30.0 + 20, a, b) for i, (a, b) in enumerate(tops)], WORD)


def test_anchors_look_words_up_in_one_pass(spark):
    found = layout.anchors(layout.row_clusters(placed(spark, [(0.0, 10.0), (0.5, 10.5)])), [("description", "the"), ("total", "the the")])
    assert "Union" not in plan(found)
    assert [(r.kind, r.x0, r.x1) for r in found.collect()] == [("total", 0.0, 50.0)]


def test_masks_within_a_licence():
    lists = [[int(m) for m in x.split(",")] for x in reconcile.WITHIN.split(";")]
    assert len(lists) == 256 and lists[0] == [0]
    assert all(lists[k] == [m for m in reconcile.MASKS if m & k == m] for k in range(1, 256))
