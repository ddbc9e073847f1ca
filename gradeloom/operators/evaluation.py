"""Scoring of extracted answers against expected ones, and model comparison.

Joins carry no broadcast hint: the planner broadcasts the expected answers when
it has measured them as small, and otherwise shuffles both sides and splits hot
cases at run time.
"""

from pyspark.sql import functions as F

from gradeloom.functions.text import overlap_of_sets, word_hashes
from gradeloom.sources.staging import stage

METRICS = [
    "category_accuracy",
    "structure_validity",
    "avg_root_cause_score",
    "avg_recommendation_score",
]


TEXT_FIELDS = ["root_cause", "recommendation"]
_WORDS = {field: f"expected_{field}_words" for field in TEXT_FIELDS}


def score_cases(analyses, cases, key="case_id", models=None):
    """Every case for every model with its answer and ``category_correct``.

    A case that a model did not answer counts as wrong and invalid, so rates are over
    all cases. ``models`` defaults to those that answered anything. Answers to unknown
    cases are left to :func:`unmatched_answers`.

    The analyses are written out, since three places read them. Cases without an answer
    are found by counting keys, not by a join; they and the answers then meet the cases
    in one join, in which a case with very many answers can be split.
    """
    analyses = stage(analyses, "analyses")
    if models is None:
        named = analyses.where("model IS NOT NULL").agg(F.sort_array(F.collect_set("model")).alias("names"))
        names = named.scalar()
    else:
        names = F.array([F.lit(m) for m in models]).cast("array<string>")
    own = [c for c in ("input", *_WORDS.values()) if c in cases.columns]
    expected = cases.select(
        key, *own, "expected_category", "expected_root_cause", "expected_recommendation"
    )
    answered = analyses.select(key, "model", F.lit(True).alias("_answered"))
    asked = cases.select(key, F.explode(names).alias("model"), F.lit(False).alias("_answered"))
    seen = asked.unionByName(answered).groupBy(key, "model").agg(F.max("_answered").alias("_answered"))
    missing = seen.where("NOT _answered")
    answers = analyses.drop(*own).withColumn("_answered", F.lit(True))
    known = F.col("model").isNotNull() if models is None else F.col("model").isin(*models)
    answers = answers.where(known)
    rows = answers.unionByName(missing, allowMissingColumns=True)
    scored = rows.join(expected, key)
    right = F.col("category").eqNullSafe(F.col("expected_category")) & F.col("_answered")
    scored = scored.withColumn("category_correct", right)
    if "is_valid" in analyses.columns:
        scored = scored.withColumn("is_valid", F.col("_answered") & F.col("is_valid"))
    return scored.drop("_answered")


def unmatched_answers(analyses, cases, key="case_id"):
    """Answers to cases that are not among the given ones."""
    return analyses.join(cases.select(key), key, "left_anti")


def with_reference_words(cases):
    """Add the word sets of the expected texts, made once per case.

    :func:`score_cases` hands them on, and :func:`add_overlap` uses them in place of the
    texts.
    """
    return cases.withColumns({name: word_hashes(F.col(f"expected_{field}")) for field, name in _WORDS.items()})


def add_overlap(scored):
    """Add word overlap of both text fields with the expected ones."""
    made = {
        name: word_hashes(F.col(f"expected_{field}"))
        for field, name in _WORDS.items()
        if name not in scored.columns
    }
    own = {f"_{field}_words": word_hashes(F.col(field)) for field in TEXT_FIELDS}
    overlaps = {
        f"{field}_overlap": overlap_of_sets(F.col(_WORDS[field]), F.col(f"_{field}_words"))
        for field in TEXT_FIELDS
    }
    return scored.withColumns({**made, **own}).withColumns(overlaps).drop(*_WORDS.values(), *own)


def percentage(condition):
    return F.avg(condition.cast("double")) * 100


def mean_or_zero(column):
    """Mean over the rows that have a value; 0 when none has."""
    return F.coalesce(F.avg(column), F.lit(0.0))


def gated_correct():
    """Correct category in an answer whose structure is valid as well."""
    answered = F.when(F.col("is_valid"), F.col("category"))
    return answered.eqNullSafe(F.col("expected_category"))


def category_accuracy(scored):
    return scored.groupBy("model").agg(
        F.count("*").alias("cases"),
        percentage(F.col("category_correct")).alias("category_accuracy"),
    )


def gated_category_accuracy(scored):
    return scored.groupBy("model").agg(
        F.count("*").alias("cases"),
        percentage(gated_correct()).alias("category_accuracy"),
    )


def structure_validity(scored):
    return scored.groupBy("model").agg(
        F.count("*").alias("cases"),
        percentage(F.col("is_valid")).alias("structure_validity"),
    )


def mean_similarity(scored):
    """Means over valid rows: elsewhere the similarities are null."""
    return scored.groupBy("model").agg(
        mean_or_zero("root_cause_similarity").alias("avg_root_cause_similarity"),
        mean_or_zero("recommendation_similarity").alias("avg_recommendation_similarity"),
    )


def mean_judge_score(judged):
    """Means over readable judge answers: elsewhere the scores are null."""
    return judged.groupBy("model").agg(
        mean_or_zero("root_cause_score").alias("avg_root_cause_score"),
        mean_or_zero("recommendation_score").alias("avg_recommendation_score"),
    )


def model_summary(judged):
    """The four metrics of each model, from one pass over the judged cases."""
    return judged.groupBy("model").agg(
        percentage(F.col("category_correct")).alias("category_accuracy"),
        percentage(F.col("is_valid")).alias("structure_validity"),
        mean_or_zero("root_cause_score").alias("avg_root_cause_score"),
        mean_or_zero("recommendation_score").alias("avg_recommendation_score"),
    )


def similarity_summary(scored):
    """As :func:`model_summary`, with similarities in place of the judge's scores."""
    return scored.groupBy("model").agg(
        percentage(F.col("category_correct")).alias("category_accuracy"),
        percentage(F.col("is_valid")).alias("structure_validity"),
        mean_or_zero("root_cause_similarity").alias("avg_root_cause_similarity"),
        mean_or_zero("recommendation_similarity").alias("avg_recommendation_similarity"),
    )


REPORT_FIELDS = [
    "case_id", "model", "input", "response", "expected_category", "category",
    "category_correct", "is_valid", "expected_root_cause", "root_cause",
    "expected_recommendation", "recommendation", "root_cause_score", "recommendation_score",
    "root_cause_similarity", "recommendation_similarity",
]


def case_report(scored):
    """Everything known of each case and model, responses whole; the scores and
    similarities only where they were worked out."""
    return scored.select(*[c for c in REPORT_FIELDS if c in scored.columns])


def side_by_side(responses, models):
    """One row per case, one column per model; of several responses the first."""
    first = F.min_by("response", "response_id")
    return responses.groupBy("case_id").pivot("model", list(models)).agg(first)


def metric_comparison(summary, base, tuned, metrics=None):
    """``(metric, base, tuned, reduction_percent)`` of any metrics of a summary."""
    metrics = [c for c in summary.columns if c != "model"] if metrics is None else metrics
    long = summary.unpivot("model", metrics, "metric", "value")
    return (
        long.groupBy("metric")
        .pivot("model", [base, tuned])
        .agg(F.max("value"))
        .withColumn(
            "reduction_percent",
            (1 - F.try_divide(F.col(tuned), F.col(base))) * 100,
        )
    )
