import pytest

import corpus_pipeline
from tallyframe.llm import bpe
from tallyframe.llm.queries_text import tokenizer_path
from tallyframe.llm.shared import table


@pytest.mark.parametrize("surface", [True, False])
def test_same_as_two_steps(spark, sf_dir, surface):
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a\0b é")], "doc_id long, text string"))
    one = bpe.round_trip(docs, path, surface=surface).select("doc_id", "ids", "decoded")
    two = bpe.decode_ids(bpe.encode_texts(docs, path).select("doc_id", "ids"), path, surface=surface)
    assert one.schema == two.schema
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_pipeline_tokens_hold_one_worker(spark, sf_dir):
    made = corpus_pipeline.tokens(spark, table(spark, sf_dir, "documents"), sf_dir)
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
