import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gradeloom.llm import best_two_fit as pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = pack.CachedEncoder(PATH)


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x it's 12,3 'SÉ's a'llb ÷×ªº²³ ÀÿØ!? don't", "a 'tis '' '1 _x x_1 \x85b"])
def test_ids_of_punctuation(text):
    assert ENCODER.encode(text) == np.asarray(_ids(text), "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("abslt'.1é÷² \n\t 　 s<|>")), max_size=40))
def test_ids_as_the_library(text):
    assert ENCODER.encode(text) == np.asarray(_ids(text), "<u4").tobytes()


@pytest.mark.parametrize("text", ["", " ", "  a", "a  <|endoftext|> b", " \n x", "a \n", "a  ", "word " * 3000])
def test_ids_of_odd_texts(text):
    assert ENCODER.encode(text) == np.asarray(_ids(text), "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("absltrvemd'.,19éœÄ \n\t\r_-")), max_size=40))
def test_ids_of_plain_texts(text):
    assert ENCODER.encode(text) == np.asarray(_ids(text), "<u4").tobytes()


def test_segments_give_the_same_ids(monkeypatch):
    text = "It's  a 12,3 test\n of \t words; ça va\u0301 " * 40 + "x" * 300
    monkeypatch.setattr(pack, "SEGMENT", 16)
    assert len([*pack._segments(text)]) > 50
    assert pack.CachedEncoder(PATH).encode(text) == np.asarray(_ids(text), "<u4").tobytes()


def test_ids_of_whole_documents():
    import pyarrow.parquet as pq

    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist():
        assert ENCODER.encode(text or "") == np.asarray(_ids(text), "<u4").tobytes()


def test_cut():
    assert pack.cut(1, 8) == [(0, 1)]
    assert pack.cut(8, 8) == [(0, 8)]
    assert pack.cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


@given(st.dictionaries(st.integers(1, 30), st.integers(0, 40), max_size=12))
def test_layouts_use_every_piece_once(histogram):
    used = defaultdict(int)
    for layout, times in pack.plan_layouts(histogram, 30):
        assert sum(layout) <= 30 and times > 0
        for size in layout:
            used[size] += times
    assert dict(used) == {k: v for k, v in histogram.items() if v}


def test_two_replace_the_smallest():
    # Greedy fills 6 + 3; 2 + 2 fill the gap left by 3 exactly.
    assert pack.plan_layouts({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)


def check_packed(rows, capacity=1024):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = pack.op9_best_two_fit(spark, sf).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.asarray(_ids(d.text) + [2], "<u4")
        pieces = sorted(found.pop(d.doc_id), key=lambda r: r.piece)
        assert sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        assert len(pieces) == 1 or all(p.length == 1024 for p in pieces[1:])
    assert not found
    needed = -(-sum(r.length for r in rows) // 1024)
    assert check_packed(rows) <= 1.02 * needed + 1


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 6), (None, "a b", 7), (2, "", 8), (3, "x " * 5000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    packed = pack.pack_documents(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in packed)[:3] == [(0, 3), (1, 1), (1, 1)]
    check_packed(packed)
    assert pack.pack_documents(df.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        pack.plan_layouts({11: 1}, 10)
