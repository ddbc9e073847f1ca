import math

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import vectors
from gradeloom.operators import evaluation, inference, probability, profile, quality, runlog, splits, similarity

SCORED = (
    "model string, category string, expected_category string, is_valid boolean, "
    "root_cause_similarity double, recommendation_similarity double, "
    "root_cause_score int, recommendation_score int"
)
CASES = [
    ("base", "A", "A", True, 0.5, 0.25, 2, 1),
    ("base", "A", "A", False, None, None, None, None),
    ("base", None, "A", False, None, None, 0, 2),
    ("base", "B", "A", True, 1.0, 0.75, 1, 0),
    ("tuned", None, "A", False, None, None, None, None),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(CASES, SCORED)
    correct = F.col("category").eqNullSafe(F.col("expected_category"))
    return df.withColumn("category_correct", correct)


def by_model(df):
    return {row["model"]: row.asDict() for row in df.collect()}


def test_denominators(scored):
    """All rows, valid rows and readable rows each have their own count."""
    assert by_model(evaluation.category_accuracy(scored))["base"]["category_accuracy"] == 50
    gated = by_model(evaluation.gated_category_accuracy(scored))
    assert gated["base"]["category_accuracy"] == 25
    assert by_model(evaluation.structure_validity(scored))["base"]["structure_validity"] == 50
    means = by_model(evaluation.mean_similarity(scored))
    assert means["base"]["avg_root_cause_similarity"] == 0.75
    assert means["tuned"]["avg_root_cause_similarity"] == 0.0
    judged = by_model(evaluation.mean_judge_score(scored))
    assert judged["base"]["avg_recommendation_score"] == 1.0
    assert judged["tuned"]["avg_root_cause_score"] == 0.0


def test_comparison(scored):
    summary = evaluation.model_summary(scored)
    rows = {r["metric"]: r for r in evaluation.metric_comparison(summary, "base", "tuned").collect()}
    assert set(rows) == set(evaluation.METRICS)
    assert rows["category_accuracy"]["base"] == 50
    assert rows["category_accuracy"]["reduction_percent"] == 100
    empty = evaluation.model_summary(scored.where("model = 'tuned'"))
    nothing = evaluation.metric_comparison(empty, "tuned", "base").first()
    assert nothing["reduction_percent"] is None


def test_no_match_and_duplicate_cases(spark):
    analyses = spark.createDataFrame(
        [(1, "base", "A"), (1, "base", None), (9, "base", "A")],
        "case_id int, model string, category string",
    )
    cases = spark.createDataFrame(
        [(1, "A", "x", "y"), (2, "B", "x", "y")],
        "case_id int, expected_category string, expected_root_cause string, "
        "expected_recommendation string",
    )
    scored = evaluation.score_cases(analyses, cases)
    assert sorted(r["category_correct"] for r in scored.collect()) == [False, False, True]
    assert [r["case_id"] for r in evaluation.unmatched_answers(analyses, cases).collect()] == [9]
    four = spark.createDataFrame([(n, "A", "x", "y") for n in range(1, 5)], cases.schema)
    one = analyses.where("category = 'A' AND case_id = 1")
    accuracy = evaluation.category_accuracy(evaluation.score_cases(one, four)).first()
    assert (accuracy["cases"], accuracy["category_accuracy"]) == (4, 25.0)


def test_answers_of_other_models_are_left_out(spark):
    analyses = spark.createDataFrame(
        [(1, "base", "A", True), (1, None, "A", True), (1, "tuned", "A", None), (2, "other", "B", True)],
        "case_id int, model string, category string, is_valid boolean",
    )
    cases = spark.createDataFrame(
        [(1, "A", "x", "y"), (2, None, "x", "y")],
        "case_id int, expected_category string, expected_root_cause string, "
        "expected_recommendation string",
    )
    rows = evaluation.score_cases(analyses, cases, models=["base", "silent"]).collect()
    got = sorted((r.model, r.case_id, r.category_correct, r.is_valid) for r in rows)
    assert got == [("base", 1, True, True), ("base", 2, False, False), ("silent", 1, False, False), ("silent", 2, False, False)]
    rows = evaluation.score_cases(analyses, cases).collect()
    assert {(r.model, r.case_id) for r in rows} == {(m, c) for m in ("base", "tuned", "other") for c in (1, 2)}
    assert [r.is_valid for r in rows if r.model == "tuned" and r.case_id == 1] == [None]


def test_each_pair_is_embedded_once(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os
        import uuid

        def vectors(texts):
            for text in texts:
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as seen:
                    seen.write(text)
            return [[float(len(t)), 1.0] for t in texts]

        return vectors

    rows = [(i, "same" if i % 3 else f"own {i % 2}", "wanted", "a", "a" if i % 2 else None, i % 5 > 0) for i in range(60)]
    df = spark.createDataFrame(
        rows, "n int, root_cause string, expected_root_cause string, recommendation string, "
        "expected_recommendation string, is_valid boolean",
    ).repartition(6)
    found = {r.n: r for r in similarity.text_similarity(df, factory).collect()}
    for n, cause, wanted, advice, expected, valid in rows:
        cosine = (len(cause) * len(wanted) + 1) / math.hypot(len(cause), 1) / math.hypot(len(wanted), 1)
        assert found[n].root_cause_similarity == (pytest.approx(cosine) if valid else None)
        assert found[n].recommendation_similarity == (pytest.approx(1.0) if valid and expected else None)
    # Four distinct pairs; a text is embedded for each of its pairs at most.
    texts = [p.read_text() for p in tmp_path.iterdir()]
    assert set(texts) == {"same", "own 0", "own 1", "wanted", "a"} and len(texts) <= 7


def test_places_go_by_order(spark):
    df = spark.createDataFrame([(10, "a"), (30, "c"), (20, "b")], "example_id int, category string")
    listing = {r["number"]: r["category"] for r in profile.category_listing(df).collect()}
    assert listing == {1: "a", 2: "b", 3: "c"}
    held = splits.split_by_position(df).where("split = 'validation'").collect()
    assert [r["example_id"] for r in held] == [20]


@pytest.mark.parametrize("slice_size", [1, 2, 3, 100])
def test_masked_logits(spark, slice_size):
    rows = list(enumerate([1.0, 2.0, float("-inf"), float("-inf")]))
    df = spark.createDataFrame([(1, c, x) for c, x in rows], "group_id int, candidate_id int, logit double")
    got = {r["candidate_id"]: r["probability"] for r in probability.softmax_long(df, slice_size=slice_size).collect()}
    assert [round(got[i], 6) for i in range(4)] == [0.268941, 0.731059, 0.0, 0.0]


def test_a_model_loads_once_per_process(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda texts: [[1.0] for _ in texts]

    df = spark.range(0, 400, 1, 40).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("t"))
    rows = inference.embed(df, "t", factory).collect()
    assert sum(r["embedding"] is None for r in rows) == sum(r["t"] is None for r in rows) > 0
    assert 1 <= len(list(tmp_path.iterdir())) <= spark.sparkContext.defaultParallelism
    with pytest.raises(Exception, match="answers to"):
        inference.embed(df, "t", lambda: lambda texts: []).collect()


def test_side_by_side(spark):
    df = spark.createDataFrame(
        [(1, 1, "base", "b"), (2, 1, "tuned", "t"), (3, 1, "base", "later"), (4, 2, "base", "x")],
        "response_id int, case_id int, model string, response string",
    )
    rows = {r["case_id"]: (r["base"], r["tuned"]) for r in evaluation.side_by_side(df, ["base", "tuned"]).collect()}
    assert rows == {1: ("b", "t"), 2: ("x", None)}


VECTORS = [([1.0, 0.0], [2.0, 0.0], 1.0), ([1.0, 0.0], [-1.0, 0.0], -1.0),
           ([0.0, 0.0], [1.0, 1.0], 0.0), ([1.0, 2.0], [2.0, -1.0], 0.0)]


def test_cosine(spark):
    df = spark.createDataFrame(VECTORS, "a array<float>, b array<float>, e double")
    both = df.select("e", vectors.cosine(F.col("a"), F.col("b")).alias("ab"),
                     vectors.cosine(F.col("b"), F.col("a")).alias("ba"))
    for row in both.collect():
        assert row["ab"] == pytest.approx(row["e"]) and row["ab"] == row["ba"]


def test_field_similarity_only_on_valid_rows(spark):
    one = "array<double>"
    df = spark.createDataFrame(
        [(True, [1.0], [1.0], [1.0], [1.0]), (False, [1.0], [1.0], [1.0], [1.0])],
        f"is_valid boolean, predicted_root_cause_embedding {one}, expected_root_cause_embedding {one}, "
        f"predicted_recommendation_embedding {one}, expected_recommendation_embedding {one}",
    )
    rows = {r["is_valid"]: r["root_cause_similarity"] for r in similarity.field_similarity(df).collect()}
    assert rows == {True: 1.0, False: None}


LOGITS = [[0.0, 0.0, 1.0], [1000.0, 1000.0, -1000.0], [3.0, 3.0, 3.0]]


def test_probabilities(spark):
    df = spark.createDataFrame([(n, x, 1) for n, x in enumerate(LOGITS)], "n int, logits array<double>, target_id int")
    rows = probability.add_probabilities(df)
    for row in rows.collect():
        weights = [math.exp(x - max(row["logits"])) for x in row["logits"]]
        assert row["probabilities"] == pytest.approx([w / sum(weights) for w in weights])
        assert sum(row["probabilities"]) == pytest.approx(1)
    best = {(r["n"], r["rank"]): r["candidate_id"] for r in probability.top_k(rows, "n", 2).collect()}
    assert best == {(0, 1): 2, (0, 2): 0, (1, 1): 0, (1, 2): 1, (2, 1): 0, (2, 2): 1}
    loss = {r["n"]: r["target_nll"] for r in probability.target_nll(rows).collect()}
    assert loss[1] == pytest.approx(math.log(2))


@pytest.mark.parametrize("slice_size", [1, 2, 1000])
def test_long_form_agrees(spark, slice_size):
    df = spark.createDataFrame([(n, x) for n, x in enumerate(LOGITS)], "group_id int, logits array<double>")
    wide = probability.top_k(probability.add_probabilities(df), "group_id", 2)
    flat = df.select("group_id", F.posexplode("logits").alias("candidate_id", "logit"))
    sliced = probability.softmax_long(flat, slice_size=slice_size)
    totals = sliced.groupBy("group_id").agg(F.sum("probability").alias("p")).collect()
    assert [r["p"] for r in totals] == pytest.approx([1.0] * len(LOGITS))
    long = probability.top_k_long(sliced, 2)
    columns = ["group_id", "rank", "candidate_id"]
    assert sorted(wide.select(columns).collect()) == sorted(long.select(columns).collect())


def test_run_log(spark):
    entry = "struct<step:int,epoch:double,loss:double,eval_loss:double,eval_mean_token_accuracy:double,eval_runtime:double>"
    log = [(1, 0.44, 2.0, None, None, None), (3, 1.0, 1.0, None, None, None), (3, 1.0, None, 2.147, 0.54, 0.2731),
           (4, 1.44, 3.0, None, None, None), (6, 2.0, None, 2.05, 0.57, 0.0)]
    logs = spark.createDataFrame([(1, log)], f"run_id int, log_history array<{entry}>")
    entries = runlog.flatten_run_log(logs)
    assert [r["kind"] for r in entries.collect()] == ["train", "train", "eval", "train", "eval"]
    epochs = {r["epoch"]: r for r in runlog.epoch_summary(entries).collect()}
    assert set(epochs) == {1, 2}
    assert epochs[1]["mean_train_loss"] == 1.5 and epochs[1]["eval_loss_change"] is None
    assert epochs[2]["eval_loss_change"] == pytest.approx(2.05 - 2.147)
    rates = [r["samples_per_second"] for r in runlog.eval_throughput(entries, F.lit(2)).collect()]
    assert rates[0] == pytest.approx(7.323, abs=1e-3) and rates[1] is None
    saved = spark.createDataFrame([(1, 3), (1, 6), (1, 9), (2, 3)], "run_id int, step int")
    kept = sorted(tuple(r) for r in runlog.retain_checkpoints(saved).collect())
    assert kept == [(1, 6), (1, 9), (2, 3)]


def test_splits_are_disjoint_and_whole(spark):
    rows = spark.range(1000).withColumnRenamed("id", "example_id")
    held = [r[0] for r in splits.split_by_position(rows).where("split = 'validation'").select("example_id").collect()]
    assert sorted(held) == [1, 4]
    shares = {r["split"]: r["count"] for r in splits.split_by_hash(rows).groupBy("split").count().collect()}
    assert sum(shares.values()) == 1000 and 150 < shares["validation"] < 250
    assert splits.split_by_hash(rows, share=0).where("split = 'validation'").count() == 0


def test_summary_and_ratio(spark):
    df = spark.createDataFrame([(2, "b c"), (1, " "), (3, "")], "example_id int, text string")
    row = profile.dataset_summary(df).first()
    assert (row["num_rows"], row["column_names"]) == (3, "example_id, text")
    assert row["first_row"] == '{"example_id":1,"text":" "}'
    ratios = {r["example_id"]: (r["word_count"], r["token_count"], r["token_word_ratio"])
              for r in profile.token_word_ratio(df).collect()}
    assert ratios == {2: (2, 2, 1.0), 1: (0, 1, None), 3: (0, 0, None)}


def test_models_see_batches(spark):
    def factory():
        calls = []

        def model(texts, max_new_tokens):
            calls.append(len(texts))
            return [f"{t}:{len(calls)}:{max_new_tokens}" for t in texts]

        return model

    df = spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("t"))
    found = [r["response"] for r in inference.generate(df, "t", factory, batch_size=4).collect()]
    assert found == [f"{n}:{n // 4 + 1}:160" for n in range(10)]
    ids = inference.tokenize_with(df, "t", lambda: lambda ts: [list(t.encode()) for t in ts])
    assert [r["ids"] for r in ids.collect()] == [[48 + n] for n in range(10)]
    vectors_of = inference.embed(df, "t", lambda: lambda ts: [[float(t), 1.0] for t in ts])
    assert vectors_of.first()["embedding"] == [0.0, 1.0]


def test_validation_report_of_good_data_is_empty(spark):
    df = spark.createDataFrame([(1, "i", "x", '{"category":"a","root_cause":"b","recommendation":"c"}')],
                               "example_id int, instruction string, input string, raw string")
    df = df.withColumn("output_raw", F.parse_json("raw"))
    checked = quality.validate_examples(df)
    assert checked.first()["errors"] == []
    assert quality.validation_report(checked).count() == 0


def test_percentiles_from_merged_sketches(spark):
    lengths = spark.range(60_000).select(
        (F.col("id") % 7).alias("part"),
        F.pow(F.col("id") % 1000, 2).cast("int").alias("token_count"),
        F.lit(True).alias("has_answer"),
        F.lit(1).alias("ignored_count"),
        F.lit(2).alias("supervised_count"),
    )
    parts = profile.length_sketches(lengths, ["part"])
    merged = profile.length_stats(profile.merge_length_sketches(parts)).first()
    whole = profile.sequence_length_stats(lengths).first()
    assert (merged.sequences, merged.min_tokens, merged.max_tokens) == (60_000, 0, 998_001)
    assert merged.avg_tokens == whole.avg_tokens
    for row in (merged, whole):
        for p in profile.PERCENTILES:
            rank = (math.isqrt(row[f"p{p}_tokens"]) + 1) / 1000
            assert abs(rank - p / 100) < 0.004
    nothing = profile.sequence_length_stats(lengths.limit(0)).first()
    assert nothing.sequences == 0 and nothing.p50_tokens is None


def test_reference_words_before_and_after_the_join(spark):
    cases = spark.createDataFrame(
        [(1, "A", "The load; the LOAD failed", ""), (2, "B", "x y", None)],
        "case_id int, expected_category string, expected_root_cause string, expected_recommendation string",
    )
    answers = spark.createDataFrame(
        [(1, "m", "A", "load it", "retry"), (2, "m", "B", None, "y")],
        "case_id int, model string, category string, root_cause string, recommendation string",
    )
    names = ["case_id", "root_cause_overlap", "recommendation_overlap"]
    early = evaluation.add_overlap(evaluation.score_cases(answers, evaluation.with_reference_words(cases)))
    late = evaluation.add_overlap(evaluation.score_cases(answers, cases))
    assert early.columns == late.columns
    assert sorted(early.select(names).collect()) == sorted(late.select(names).collect())
    assert {r.case_id: r.root_cause_overlap for r in late.collect()}[1] == pytest.approx(1 / 3)
