import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gradeloom.llm import rank_array_bpe as bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODEL = bpe.RankArrayBpe(PATH)
TEXTS = [
    None, "", "   ", "Hello  WORLD's it'll 123", "a b c", "été ÜİΣ",
    "x<|startoftext|>Y <|endoftext|>", "你好 \U0001f600!!! ...", "ab" * 500, "!" * 300, "a\x1cb\x85c",
    "don't\nstop\t\r\nthe '' 's", "ﬁ Å ẞ",
]


def _expected(text):
    coded = LIBRARY.encode(text or "", add_special_tokens=False)
    return coded.ids, LIBRARY.decode(coded.ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(text):
    ids, decoded = _expected(text)
    assert MODEL.encode(text) == ids
    assert MODEL.encode_decode(text) == (len(ids), " ".join(map(str, ids)), decoded)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids, decoded = _expected(text)
    assert MODEL.encode_decode(text) == (len(ids), " ".join(map(str, ids)), decoded)


@given(st.text("abest'", min_size=1, max_size=90))
def test_scan_and_heap_agree(word):
    parts = [*word[:-1], word[-1] + "</w>"]
    assert MODEL._merge_short(list(parts)) == MODEL._merge_long(list(parts))


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(1, "same", "x"), (1, "same", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode_decode_digests(df, PATH).collect()
    assert len(got) == len(rows)
    for row in got:
        ids, decoded = _expected(row.text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_decode_digests(df.limit(0), PATH).collect() == []


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(df, PATH), PATH).orderBy("doc_id").collect()
    assert [(r.ids, r.decoded) for r in rows] == [(_expected(t)[0], _expected(t)[1]) for t in ("Hello world", None)]


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in bpe.op10_rank_array_bpe(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids, decoded = _expected(d.text)
        assert rows[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
