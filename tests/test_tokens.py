import collections

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions import tokens as T
from gradeloom.operators import masking, vocabulary as V
from gradeloom.plans import preparation
from gradeloom.sources.staging import stage

TEXTS = [
    "the the the the cat sat on the mat, the end",
    "",
    "Straße ist naß   und die\tKatze\n\n",
    "<|im_start|>assistant\nhello <|im_end|>\n x<|im_start|> y",
    "rare1 rare2 rare3 the cat rare1",
    "😀 emoji ’quotes’ a_b c-d 12.5",
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string")
    return df.withColumn("tokens", T.tokenize(F.col("text")))


@pytest.fixture(scope="module")
def words(rows):
    return stage(V.build_vocabulary(rows), "vocabulary")


def test_tokens_join_to_the_text(rows):
    for row in rows.collect():
        assert "".join(row["tokens"]) == row["text"]


def test_special_tokens_stay_whole(rows):
    tokens = {r["n"]: r["tokens"] for r in rows.collect()}[3]
    assert tokens[:3] == T.ASSISTANT_MARKER
    assert tokens.count("<|im_start|>") == 2 and tokens.count("<|im_end|>") == 1


def test_vocabulary(rows, words):
    counts = collections.Counter(t for r in rows.collect() for t in r["tokens"])
    order = sorted(counts.items(), key=lambda item: (-item[1], item[0].encode()))
    found = [(r["token"], r["count"]) for r in words.orderBy("id").collect()]
    assert found == order
    assert [r["id"] for r in words.orderBy("id").collect()] == list(range(len(order)))


@pytest.mark.parametrize("max_tokens", [200_000, 5, 3, 1])
def test_encode_and_decode(rows, words, max_tokens):
    """The lookup alone, and most tokens through the join."""
    ids = {r["token"]: r["id"] for r in words.collect()}
    encoded = V.encode(rows, words, max_tokens=max_tokens)
    decoded = V.decode(encoded, words, max_tokens=max_tokens)
    found = decoded.collect()
    assert len(found) == len(TEXTS)
    for row in found:
        assert row["ids"] == [ids[t] for t in row["tokens"]]
        assert row["decoded"] == row["text"]


def test_a_long_token_shrinks_the_lookup(spark):
    df = spark.createDataFrame(
        [("a", 0, 3), ("x" * 500, 1, 2), ("b", 2, 1)], "token string, id int, count long"
    )
    assert V.lookup_size(df, 16, max_bytes=1000) == 3
    assert V.lookup_size(df, 16, max_bytes=100) == 1


@pytest.mark.parametrize("max_tokens", [200_000, 3, 2, 1])
def test_repeated_and_missing_keys(spark, max_tokens):
    texts = [(1, "a a rare1 b"), (1, "a rare2 rare2"), (None, "a rare3"), (None, None)]
    df = spark.createDataFrame(texts, "k int, text string")
    df = df.withColumn("tokens", T.tokenize(F.col("text")))
    words = stage(V.build_vocabulary(df), "vocabulary")
    encoded = V.encode(df, words, max_tokens=max_tokens)
    found = V.decode(encoded, words, max_tokens=max_tokens).collect()
    assert sorted((r["text"], r["decoded"]) for r in found if r["text"]) == sorted(
        (t, t) for _, t in texts if t
    )
    assert len(found) == 4


@pytest.mark.parametrize("max_tokens", [200_000, 3])
def test_unknown_and_special(spark, rows, words, max_tokens):
    new = spark.createDataFrame([(1, ["the", "never seen"]), (2, None)], "n int, tokens array<string>")
    found = {r["n"]: r["ids"] for r in V.encode(new, words, max_tokens=max_tokens).collect()}
    assert found[1][1] == V.UNKNOWN_ID and found[1][0] >= 0
    assert found[2] is None
    encoded = V.encode(rows, words)
    plain = V.decode(encoded, words, skip_special_tokens=True, max_tokens=max_tokens)
    text = {r["n"]: r["decoded"] for r in plain.collect()}[3]
    assert text == "assistant\nhello \n x y"


def test_slices_join_their_distinct_tokens_only(spark):
    texts = [(n, ["a"] * 50 + ["b", f"own {n}"] if n % 7 else None) for n in range(40)] + [(40, []), (41, ["a", None, "a"])]
    df = spark.createDataFrame(texts, "n int, tokens array<string>").coalesce(1)
    sliced = V.slice_items(df, slice_items=300)
    entries = sliced.entries.collect()
    assert len({e._slice for e in entries}) > 4
    assert len(entries) == len({(e._slice, e.item) for e in entries}) < 100
    words = stage(V.build_vocabulary(sliced), "vocabulary")
    counts = collections.Counter(t for _, tokens in texts for t in tokens or [] if t)
    assert {r["token"]: r["count"] for r in words.collect()} == counts
    ids = {r["token"]: r["id"] for r in words.collect()}
    for max_tokens in (1, 3, 30_000):
        rows = {r["n"]: r for r in V.encode(sliced, words, max_tokens=max_tokens).collect()}
        for n, tokens in texts:
            assert rows[n]["tokens"] == tokens
            assert rows[n]["ids"] == (None if tokens is None else [ids.get(t, V.UNKNOWN_ID) for t in tokens])
        back = V.decode(V.encode_slices(sliced, words, max_tokens), words, max_tokens=max_tokens)
        for r in back.collect():
            tokens = texts[r["n"]][1]
            known = None if tokens is None else "".join(t or V.UNKNOWN_TOKEN for t in tokens)
            assert r["decoded"] == known


MARK = [7, 8, 9]
SEQUENCES = [
    [1, 7, 8, 9, 2, 3],
    [7, 8, 9, 1, 7, 8, 9, 4, 5, 6, 11],
    [7, 8, 9],
    [1, 2, 7, 8],
    [],
    [7, 7, 8, 9, 7, 8],
]


def masked_by_hand(ids):
    ends = [i + 3 for i in range(len(ids) - 2) if ids[i : i + 3] == MARK]
    if not ends:
        return None
    return [C.IGNORE_LABEL if i < ends[-1] else t for i, t in enumerate(ids)]


def test_loss_mask(spark):
    df = spark.createDataFrame(list(enumerate(SEQUENCES)), "n int, ids array<int>")
    for row in masking.add_loss_mask(df, MARK).collect():
        assert row["labels"] == masked_by_hand(row["ids"])
        assert row["has_answer"] == (row["labels"] is not None)
    counted = masking.add_loss_mask(df, MARK).where("has_answer").withColumn(
        "ignored", T.ignored_count(F.col("labels"))
    )
    for row in counted.collect():
        assert row["ignored"] == row["answer_start"]


def test_loss_mask_strict_and_end_marker(spark):
    df = spark.createDataFrame([(1, SEQUENCES[1])], "n int, ids array<int>")
    labels = masking.add_loss_mask(df, MARK, end_marker=5).first()["labels"]
    assert labels == [-100] * 7 + [4, 5, -100, -100]
    bad = spark.createDataFrame([(1, [1, 2])], "n int, ids array<int>")
    with pytest.raises(PySparkException, match="no assistant turn"):
        masking.add_loss_mask(bad, MARK, strict=True).collect()


def test_slices(spark):
    df = spark.createDataFrame([([1, 2], [1, 2, 3, 4])], "i array<int>, o array<int>")
    got = df.select(
        T.completion_slice(F.col("o"), F.col("i")), T.truncate(F.col("o"), 3)
    ).first()
    assert got[0] == [3, 4] and got[1] == [1, 2, 3]


def test_training_table(spark):
    df = spark.createDataFrame(
        [(n, "Do it.", f"Case {n}.", ("X", f"cause {n}", "advice")) for n in range(40)],
        "example_id long, instruction string, input string, "
        "output struct<category:string,root_cause:string,recommendation:string>",
    )
    rows = preparation.training_table(df, 50).collect()
    assert len(rows) == 40
    for row in rows:
        assert len(row["ids"]) == len(row["labels"]) == 50
        trained = [t for t in row["labels"] if t != C.IGNORE_LABEL]
        assert trained and row["ids"][-len(trained):] == trained
    assert {row["split"] for row in rows} == {"train", "validation"}
