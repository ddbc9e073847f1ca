"""One key with a large share of the rows: same results, work spread out."""

import contextlib

from pyspark.sql import functions as F

from gradeloom.operators import conversations, evaluation, ordering, probability, vocabulary
from gradeloom.functions import tokens as T
from gradeloom.sources.staging import stage


@contextlib.contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_case_is_split_by_the_join(spark, capsys):
    """Without a broadcast, a case with half of the responses is many tasks."""
    analyses = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("case_id"),
        F.lit("base").alias("model"),
        F.lit("A").alias("category"),
        F.sha2(F.col("id").cast("string"), 512).alias("root_cause"),
    )
    cases = spark.range(0, 200_000).select(
        F.col("id").alias("case_id"),
        F.lit("A").alias("expected_category"),
        F.sha2(F.col("id").cast("string"), 512).alias("expected_root_cause"),
        F.lit("c").alias("expected_recommendation"),
    )
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="256kb",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="512kb",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        scored = evaluation.score_cases(analyses, cases)
        summary = scored.groupBy("model").agg(
            F.count("*").alias("n"),
            F.max("root_cause").alias("a"),
            F.max("expected_root_cause").alias("b"),
        )
        assert summary.collect()[0]["n"] == 300_000
        capsys.readouterr()
        summary.explain()
        assert "skew=true" in capsys.readouterr().out


def test_hot_conversation(spark):
    """A very long conversation: whole text, right labels."""
    size = 20_000
    turns = spark.range(0, size, 1, 4).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    whole = conversations.render_conversations(turns).first()["rendered"]
    assert whole.count("<|im_start|>system") == 1
    assert whole.endswith(f"<|im_start|>assistant\nt{size - 1}<|im_end|>\n")
    uses = conversations.label_turns(turns).groupBy("use").count().collect()
    assert {r["use"]: r["count"] for r in uses} == {"prompt": size - 1, "completion": 1}


def test_hot_group_is_numbered_in_slices(spark):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("g"),
        F.col("id").alias("n"),
    )
    numbered = ordering.number_rows(rows, [F.desc("n")], "place", ["g"])
    hot = numbered.where("g = -1").agg(F.max("place"), F.countDistinct("place")).first()
    assert tuple(hot) == (40_000, 40_000)
    assert numbered.where("g <> -1 AND place <> 1").count() == 0


def test_hot_softmax_group(spark):
    rows = spark.range(0, 50_000, 1, 8).select(
        F.lit(1).alias("group_id"), F.col("id").alias("candidate_id"),
        (F.col("id") % 100).cast("double").alias("logit"),
    )
    found = probability.softmax_long(rows, slice_size=1000)
    total = found.agg(F.sum("probability")).first()[0]
    assert abs(total - 1) < 1e-9
    best = probability.top_k_long(found, 3).orderBy("rank").collect()
    assert [r["candidate_id"] for r in best] == [99, 199, 299]


def test_hot_token(spark):
    """A token with most of the rows is counted near the data and never joined."""
    texts = spark.range(0, 3000, 1, 8).select(
        "id", F.concat(F.lit("hot hot hot "), F.lit("w"), F.col("id")).alias("text")
    )
    rows = texts.withColumn("tokens", T.tokenize(F.col("text")))
    words = stage(vocabulary.build_vocabulary(rows), "vocabulary")
    assert words.orderBy("id").first()["count"] == 6000
    encoded = vocabulary.encode(rows, words, max_tokens=2)
    decoded = vocabulary.decode(encoded, words, max_tokens=2)
    assert decoded.where("decoded <> text").count() == 0 and decoded.count() == 3000
