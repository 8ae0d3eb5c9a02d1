import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import bpe
from tallyframe.llm.queries_text import op4_bpe, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()


def same(text):
    ours, ids = bpe.load(PATH).encode(text).tolist(), LIBRARY.encode(text, add_special_tokens=False).ids
    assert ours == ids
    decoder = bpe.SurfaceDecoder(bpe.load(PATH).m)
    pieces = [decoder.feed(ours[i : i + 3]) for i in range(0, len(ours), 3)]
    assert "".join(pieces) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abehinorst' ", max_size=400))
def test_long_words(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", "it's we'll 12 ÀΣΟΣ", "<|endoftext|>a<|startoftext|>", "a" * 5000, "haha" * 900 + "!", "é" * 3000, "﷽‍ x\x1cy", "İIİ"])
def test_cases(text):
    same(text)


def test_emits_before_the_end_of_a_word():
    encoder = bpe.load(PATH)
    word = bpe.WordEncoder(encoder.m)
    early = list(word.feed("thering" * 400))
    assert early and len(word.last) < 400
    assert early + word.finish("s") == LIBRARY.encode("thering" * 400 + "s", add_special_tokens=False).ids


def test_text_decoder():
    encoder = bpe.load(PATH)
    machine = bpe.TextDecoder(encoder.m)
    ids = encoder.encode("naïve 日本 <|endoftext|>x").tolist()
    assert "".join([machine.feed([i]) for i in ids]) + machine.finish() == "naïve 日本 <|endoftext|>x "


def test_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b")], "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    rows = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH).orderBy("doc_id").collect()
    assert [(r.ids, r.decoded) for r in rows] == [([], ""), ([], "")] + [(LIBRARY.encode("a b").ids, "a</w> b</w>")] * 2
    assert bpe.encode_texts(df.limit(0), PATH).collect() == []


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op4_bpe(spark, sf_dir).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
