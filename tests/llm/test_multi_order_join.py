import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st

from gradeloom.llm import multi_order_join as mo
from gradeloom.llm.components import components


def shingles(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute(rows, shared=85, of=100, words=4):
    sets = {i: shingles(t, words) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, y in combinations(sorted(sets), 2):
        a, b = sets[x], sets[y]
        if a and b and of * len(a & b) >= shared * len(a | b):
            r, s = sorted((root(x), root(y)))
            label[s] = r
    return {i: (len(sets[i]), root(i)) for i in sets}


def result(df, settings=mo.Settings()):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in mo.near_duplicates(df, settings).collect()}


def texts_with_edits(seed, n=150, words=60, passage=False):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [word() for _ in range(25)]
    bases = [[word() for _ in range(rng.randrange(5, words))] for _ in range(n // 10)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        if rng.random() < 0.7:
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = word()
        if passage:
            text = shared + text[:30]
        rows.append((i, rng.choice([" ", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("seed, passage, short_list", [(1, False, 24), (2, False, 2), (3, True, 24), (4, True, 3)])
def test_against_all_pairs(spark, seed, passage, short_list):
    rows = texts_with_edits(seed, passage=passage)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, mo.Settings(short_list=short_list)) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "One"), (9, "oNE"), (10, "one two"), (11, "É x y z"), (12, "é x y z"), (13, "a " * 60000), (14, "a " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == {}
    again = df.union(df).union(spark.createDataFrame([(None, "One"), (None, None)], df.schema))
    got = mo.near_duplicates(again.selectExpr("*", "1 as n", "2 as component_id")).collect()
    assert len(got) == 22
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(rows)


@hypothesis_settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.randoms())
def test_filters_keep_similar_sets(tokens, rng):
    other = set(tokens)
    for _ in range(rng.randrange(0, 8)):
        if rng.random() < 0.5 and len(other) > 1:
            other.discard(rng.choice(sorted(other)))
        else:
            other.add(rng.randrange(2**64))
    x, y = (np.array(sorted(s), np.uint64) for s in (tokens, other))
    settings = mo.Settings()
    if mo.similar(x, y, settings)[1]:
        assert mo.agree(x, y, settings)
        for order in range(3):
            assert set(mo.head(x, order, settings)) & set(mo.head(y, order, settings))
        assert set(mo.part_keys(x, settings)) & set(mo.part_keys(y, settings))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (None, 3), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {j: 100 for j in [*range(100, 160), 200]}
    assert components(df.limit(0)).collect() == []


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in mo.op4_multi_order_join(spark, sf).collect()}
    assert got == brute(rows)
    assert any(i != c for i, (_, c) in got.items())


def test_texts_that_share_a_passage_need_few_rounds(spark):
    """1,500 texts share 35 of 50 words, none of them is similar to another but a few."""
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(35)]
    rows = [(i, " ".join(shared + [f"w{rng.randrange(10**7)}" for _ in range(15)])) for i in range(1500)]
    rows += [(5000 + i, rows[i][1] + " more") for i in range(0, 40, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = result(df)
    linked = {i: c for i, (_, c) in found.items() if i != c}
    assert linked == {5000 + i: i for i in range(0, 40, 2)}


def test_long_texts_in_segments(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(n)).encode() for n in (0, 2, 3, 40, 900)]
    texts += [b"x" * 500, b"a " * 300, b"  ", b"one two three " + b"y" * 200 + b" four"]
    for words in (1, 4, 5):
        whole = mo.text_sets(texts, words)
        with monkeypatch.context() as patch:
            patch.setattr(mo, "SEGMENT", 64)
            parts = mo.text_sets(texts, words)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, parts))


def test_long_texts_take_little_memory():
    import resource

    long = (b"word%d and others " * 100_000) % tuple(range(100_000)) * 16  # 30 MB
    many = [b"some words of a text " * 120] * 10_000
    for texts in ([long], many):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        mo.text_sets(texts, 5)
        assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_rounds_of_long_lists_are_few(spark, monkeypatch):
    """160 texts in one list of which few are linked: not one round for each of them."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**7)}"
    base = [word() for _ in range(60)]
    rows = []
    for i in range(160):
        text = list(base)
        for at in rng.sample(range(60), rng.choice([1, 2, 3, 4])):
            text[at] = word()
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    names, stage = [], mo.stage
    monkeypatch.setattr(mo, "stage", lambda df, name, **options: names.append(name) or stage(df, name, **options))
    assert result(df, mo.Settings(short_list=2, rounds=1)) == brute(rows)
    assert 1 <= names.count("stars") <= 6


def test_members_of_two_heads_still_meet(spark, monkeypatch):
    """Chains whose links join members that belong to different heads."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**7)}"
    rows, text = [], [word() for _ in range(90)]
    for i in range(120):
        text = list(text)
        text[rng.randrange(90)] = word()
        rows.append((rng.randrange(10**6), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(mo, "FIRST_HEADS", 8)
    assert result(df, mo.Settings(short_list=2, rounds=1)) == brute(rows)
