import re
from collections import Counter

from pyspark.sql import functions as F

from gradeloom.llm import decision_list as dl


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def found(row):
    return tuple(row[c] for c in (*dl.STATISTICS, "base_failed"))


TEXTS = [
    None, "", " \t\n", "one", "a b c d e", "a b c d e f a b c d e", "x " * 4000, "é😀 ü\x0b\x0c\r|<>",
    "line\nline\n \nline ", "a b c d e a b c d e a b c d x y z " * 3, "\x85w1  w2",
    " ".join(str(i) for i in range(20000)), "ab c d e f abc d e f g",
]


def test_statistics(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(None, "a b", "x", 7), (1, "", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = dl.judge(df, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert found(r) == brute(r.text)
        assert r.kept == (not r.base_failed)
    assert dl.judge(df.limit(0), labels).collect() == []


def labelled(spark):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("w"), (F.col("doc_id") * 37 + i * i).cast("string"))))
    df = spark.range(600).withColumnRenamed("id", "doc_id")
    bad = F.col("doc_id") % 4 == 0
    df = df.withColumn("text", F.when(bad, F.regexp_replace(words, " ", "### ")).otherwise(words))
    labels = df.select("doc_id", F.when(bad, 0).otherwise(1).alias("quality"), F.lit(1).alias("text"))
    return df, labels


def test_learns_a_rule(spark):
    df, labels = labelled(spark)
    rows = dl.judge(df, labels.where("doc_id % 3 > 0").union(labels.where("doc_id = 1"))).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in rows)


def test_rules_are_pruned_and_ordered(spark):
    df, labels = labelled(spark)
    sample = dl.labelled_sample(df, labels, "doc_id", "quality", dl.Settings(sample_rows=300))
    assert sample.count() == 300
    rules = dl.fit(sample, dl.features(), "_label", "_key")
    assert len(rules) == 1 and len(rules[0]) == 1


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = dl.op3_decision_list(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert found(r) == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_no_python_in_the_plan(spark):
    df, labels = labelled(spark)
    plan = dl.judge(df, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
