import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import compare
from gradeloom.llm import target_resampling as tr

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, settings):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % settings.buckets

    s = Counter(bucket(f) for _, text in docs for f in features(text, settings.longest)[0])
    t = Counter(bucket(f) for text in target for f in features(text, settings.longest)[0])
    alls, allt = sum(s.values()) + settings.buckets, sum(t.values()) + settings.buckets
    rows = []
    for key, text in docs:
        found, words = features(text, settings.longest)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * alls / ((s[b] + 1) * allt))) for b in map(bucket, found)
        )
        h = int(hashlib.sha256(f"{settings.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, words, len(found), weight, score, None])
    able = [r for r in rows if r[1] >= settings.min_words]
    able.sort(key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: settings.percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, rows), key=str)


def shown(df):
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_query_against_sql(spark):
    names, rows = compare.rows_of_spark(tr.op13_target_resampling(spark, SF))
    sql_names, sql_rows = compare.rows_of_duckdb(compare.connect(SF), tr._SQL)
    assert names == sql_names
    assert compare.difference(rows, sql_rows) is None


@pytest.mark.parametrize("settings", [tr.Settings(), tr.Settings(longest=3, buckets=64, percent=37, accuracy=8, margin=0.0)])
def test_against_brute_force(spark, settings):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute([tuple(r) for r in docs.collect()], [r.text for r in target.collect()], settings)
    assert shown(tr.resample(docs, target, settings)) == expected


def test_segments_change_nothing(monkeypatch):
    text = "Aa b1 cé-d " * 50 + "x" * 90 + " Y z"
    settings = tr.Settings(longest=3)
    whole = tr.text_buckets(text, settings)
    monkeypatch.setattr(tr, "SEGMENT", 16)
    words, arrays = tr.text_buckets(text, settings)
    assert words == whole[0] and len(arrays) > 9
    assert Counter(int(c) for a in arrays for c in a) == Counter(int(c) for a in whole[1] for c in a)


def test_odd_rows(spark):
    long = "alpha beta " * 300_000
    rows = [(1, None, 7), (2, "", 7), (None, "a b c " * 9, 7), (3, long, 7), (3, long, 7), (3, long, 7), (4, "a b " * 20, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank int")
    df = df.withColumns({"weight": F.lit("mine"), "lang": F.lit("en")})
    target = spark.createDataFrame([("alpha",), (None,)], "text string")
    settings = tr.Settings(percent=60)
    found = tr.resample(df, target, settings)
    assert "lang" in found.columns and "text" not in found.columns
    assert shown(found) == brute([r[:2] for r in rows], ["alpha", None], settings)
    assert tr.resample(df.limit(0), target).collect() == []
    untargeted = tr.resample(df, target.limit(0), settings)
    assert shown(untargeted) == brute([r[:2] for r in rows], [], settings)


def test_hot_score_and_exact_cutoff(spark):
    """A third of the rows share a score, right at the cutoff."""
    rows = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.lit(20).cast("long").alias("n_words"),
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000).cast("long").alias("score"),
    )
    drawn = tr.draw(rows, tr.Settings(percent=50, accuracy=8, margin=0.0)).where("rank is not null").collect()
    expected = sorted(((r.score, r.doc_id) for r in rows.collect()), key=lambda r: (-r[0], r[1]))[:4500]
    assert [(r.score, r.doc_id) for r in sorted(drawn, key=lambda r: r["rank"])] == expected
    assert [r["rank"] for r in sorted(drawn, key=lambda r: r["rank"])] == list(range(1, 4501))
