import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import noisy_channel as nc

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(8)
    return nc.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(8)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = nc.score(documents, model).join(labels, "doc_id").where(nc.held_out())
    rows = rows.select("doc_id", "toxic", "predicted").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    caught = [r.toxic for r in rows if r.predicted]
    assert sum(caught) / len(caught) > 0.95
    assert sum(caught) / sum(r.toxic for r in rows) > 0.8


@pytest.mark.parametrize("word", ["st*p1d", "stuuuupid", "$tupid", "s.t.u.p.i.d", "STUP1D!!"])
def test_disguises_are_undone(model, word):
    assert nc.Reader(model.log, (4,)).word(word) == "stupid"
    assert model.score(f"the and {word} of thing") > 0.7


def test_letters_apart(model):
    assert model.score("of the s t u p i d and") > 0.7
    assert model.score("a b c") < 0.1


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    log = nc.LanguageModel(rng.integers(0, 50, nc.SYMBOLS**3)).log

    def value(path):
        total, a, b = sum(cost for _, cost in path), 0, 0
        for c in "".join(c for c, _ in path):
            z = nc._SYMBOL_OF.get(c, 0)
            total, a, b = total + log[a][b][z], b, z
        return total + log[a][b][0]

    for word in ("1d10t", "s..t$", "aaab!!", "x", "@@"):
        best = max(itertools.product(*nc.lattice(word)), key=value)
        assert nc.decode(word, log) == "".join(c for c, _ in best)


def test_language_model_counts_every_text(spark):
    df = spark.createDataFrame([("ab",), (None,), ("",), ("ab",)], "text string")
    log = nc.fit_language_model(df).log
    a, b, c = (nc._SYMBOL_OF[x] for x in "abc")
    assert log[0][a][b] > log[0][a][c]
    assert nc.symbol_counts("\n\nab\n\n")[(0 * 64 + a) * 64 + b] == 1


def test_pieces_count_as_the_whole(monkeypatch):
    texts = ["abc def", "x", "long text " * 9, "yz"]
    whole = nc.symbol_counts("\n\n" + "\n\n".join(texts) + "\n\n")
    monkeypatch.setattr(nc, "PIECE", 7)
    total = np.zeros(nc.SYMBOLS**3, np.int64)
    pieces = [*nc._pieces(texts)]
    for piece in pieces:
        found = nc.symbol_counts(piece)
        total[: len(found)] += found
    assert len(pieces) > 10 and (total[: len(whole)] == whole).all() and total.sum() == whole.sum()


def test_counting_takes_little_memory(spark):
    """A text of 30 MB, and 10,000 texts in one batch."""
    import resource

    batch = pa.RecordBatch.from_arrays([pa.array(["some words of a text " * 120] * 10_000)], ["text"])
    long = pa.RecordBatch.from_arrays([pa.array(["many words " * 2_700_000])], ["text"])
    for given in (batch, long):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        for piece in nc._pieces(t.as_py() for t in given.column(0)):
            nc.symbol_counts(piece)
        assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000


def brute_scores(rows, labels, model):
    """Scores from the definition: every word by the likeliest reading, two strongest."""
    reader = nc.Reader(model.log, model.beginnings)
    out = {}
    for key, text in rows:
        tokens = (text or "").split()
        tokens += reader.spaced(text or "")
        values = sorted((max((model.weights.get(k, 0.0) for k in reader.keys(t)), default=0.0) for t in tokens), reverse=True)
        a, b = model.curve
        out[key] = 1 / (1 + np.exp(-np.clip(a + b * sum(values[:2]), -30, 30)))
    return out


def test_query_against_brute_force(spark):
    """Weights from plain counts over the rows learned from, scores from plain sums."""
    sf = "/root/testdata/sf0.01"
    documents = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    model = nc.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    counts = np.zeros(nc.SYMBOLS**3)
    for _, text in documents:
        found = nc.symbol_counts("\n\n" + text + "\n\n") if text else []
        counts[: len(found)] += found
    # Line breaks between texts are counted a little differently in one long run.
    plain = np.array(nc.LanguageModel(counts).log)
    assert np.abs(plain[1:, 1:, 1:] - np.array(model.log)[1:, 1:, 1:]).max() < 0.05
    found = {r.doc_id: r for r in nc.op7_noisy_channel(spark, sf).collect()}
    expected = brute_scores(documents, labels, model)
    assert set(found) == set(expected)
    for key, value in expected.items():
        assert found[key].score == pytest.approx(value)
        assert found[key].held_out == (zlib.crc32(str(key).encode()) % 3 == 1)


def test_odd_rows(spark, model):
    rows = [(1, None, 0.5), (1, None, 0.5), (None, "", 0.5), (2, "x" * 200000, 0.5), (3, "1" * 9999 + "a", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    scored = nc.score(df, model).withColumn("held_out", nc.held_out()).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 and r.predicted == 0 for r in scored)
    assert [r.held_out for r in scored if r.doc_id is None] == [False]
    assert nc.score(df.limit(0), model).collect() == []
    labels = df.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    untaught = nc.fit(df.drop("score"), labels)
    assert {r.predicted for r in nc.score(df, untaught).collect()} == {0}


def test_rare_toxic_words_weigh_beside_many_common_ones(spark):
    letters = "bcdfghklmnprstvw"
    common = ["".join(w) for w in itertools.islice(itertools.product(letters, "aeiou", letters, "aeiou", "lnrt"), 21_000)]
    rows = [(i, " ".join(common) + (" zuqqivox" if 8 <= i < 40 else "")) for i in range(48)]
    rows += [(100 + i, f"own words of text {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = df.select("doc_id", (F.col("doc_id") < 100).cast("int").alias("toxic"))
    assert "=zuqqivox" in nc.fit(df, labels).weights


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = nc.op7_noisy_channel(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
