"""Extraction, text scoring, judging and model comparison."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.catalog import sql as S
from gradeloom.catalog.fixtures import MODELS, duckdb_ctes, fixture, table
from gradeloom.catalog.models import letter_profile
from gradeloom.catalog.registry import query
from gradeloom.functions import extract, judge, text
from gradeloom.operators import evaluation, judging, quality, responses, similarity
from gradeloom.sources.staging import stage

_ANALYSED = duckdb_ctes("responses")[:-1] + ",\n" + S.ANALYSED
_SCORED = duckdb_ctes("responses", "eval_cases")[:-1] + ",\n" + S.ANALYSED[:-1] + ",\n" + S.SCORED
_JUDGED = duckdb_ctes("judge_answers")[:-1] + ",\n" + S.judge_ctes("judge_answers", "judge_response")


def analysed(spark, sf_dir):
    rows = responses.extract_analysis(fixture(spark, sf_dir, "responses"))
    return quality.add_structure_validity(rows)


def scored(spark, sf_dir):
    cases = fixture(spark, sf_dir, "eval_cases")
    return evaluation.score_cases(analysed(spark, sf_dir), cases)


def _labels(name, sql):
    @query(
        name,
        duckdb_ctes("responses") + f"SELECT response_id, {sql} AS {name} FROM responses",
    )
    def labels(spark, sf_dir):
        rows = responses.extract_category(fixture(spark, sf_dir, "responses"))
        return rows.select("response_id", name)

    return labels


canonical_label = _labels("canonical_label", S.canonical("upper(response)"))
phrase_label = _labels("phrase_label", S.phrases("upper(response)"))


@query("extract_category", _ANALYSED + "SELECT response_id, category FROM analysed")
def extract_category(spark, sf_dir):
    rows = responses.extract_category(fixture(spark, sf_dir, "responses"))
    return rows.select("response_id", "category")


@query("extract_root_cause", _ANALYSED + "SELECT response_id, root_cause FROM analysed")
def extract_root_cause(spark, sf_dir):
    rows = responses.extract_analysis(fixture(spark, sf_dir, "responses"))
    return rows.select("response_id", "root_cause")


@query(
    "extract_recommendation",
    _ANALYSED + "SELECT response_id, recommendation FROM analysed",
)
def extract_recommendation(spark, sf_dir):
    rows = responses.extract_analysis(fixture(spark, sf_dir, "responses"))
    return rows.select("response_id", "recommendation")


@query(
    "extract_analysis",
    _ANALYSED + "SELECT response_id, category, root_cause, recommendation FROM analysed",
)
def extract_analysis(spark, sf_dir):
    rows = responses.extract_analysis(fixture(spark, sf_dir, "responses"))
    return rows.select("response_id", "category", "root_cause", "recommendation")


@query(
    "response_preview",
    _ANALYSED
    + """SELECT response_id, substr(root_cause, 1, 150) AS root_cause,
 substr(recommendation, 1, 150) AS recommendation, substr(response, 1, 300) AS response
FROM analysed""",
)
def response_preview(spark, sf_dir):
    sizes = {"root_cause": 150, "recommendation": 150, "response": 300}
    return analysed(spark, sf_dir).select(
        "response_id", *[extract.preview(F.col(c), n).alias(c) for c, n in sizes.items()]
    )


@query(
    "normalize_text",
    f"SELECT doc_id, {S.normalised('text')} AS normalized FROM documents",
)
def normalize_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    normalized = text.normalize_text(F.col("text"))
    return documents.select("doc_id", normalized.alias("normalized"))


@query(
    "word_overlap",
    "SELECT d.doc_id, round("
    + S.overlap("n.text", "d.text")
    + """, 6) AS word_overlap
FROM documents d JOIN documents n ON n.doc_id = d.doc_id + 1""",
)
def word_overlap(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    words = documents.select("doc_id", text.word_set(F.col("text")).alias("words"))
    following = words.select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("words").alias("reference")
    )
    overlap = text.overlap_of_sets(F.col("reference"), F.col("words"))
    return words.join(following, "doc_id").select(
        "doc_id", F.round(overlap, 6).alias("word_overlap")
    )


@query(
    "evaluate_prediction",
    _SCORED
    + f"""SELECT response_id, category_correct,
 round({S.overlap('expected_root_cause', 'root_cause')}, 6) AS root_cause_overlap,
 round({S.overlap('expected_recommendation', 'recommendation')}, 6) AS recommendation_overlap
FROM scored""",
)
def evaluate_prediction(spark, sf_dir):
    cases = evaluation.with_reference_words(fixture(spark, sf_dir, "eval_cases"))
    rows = evaluation.add_overlap(evaluation.score_cases(analysed(spark, sf_dir), cases))
    return rows.select(
        "response_id",
        "category_correct",
        F.round("root_cause_overlap", 6).alias("root_cause_overlap"),
        F.round("recommendation_overlap", 6).alias("recommendation_overlap"),
    )


_COSINE = (
    "list_dot_product({0}::DOUBLE[], {1}::DOUBLE[]) / "
    "(greatest(sqrt(list_dot_product({0}::DOUBLE[], {0}::DOUBLE[])), 1e-12) * "
    "greatest(sqrt(list_dot_product({1}::DOUBLE[], {1}::DOUBLE[])), 1e-12))"
)


@query(
    "cosine_similarity",
    f"""SELECT a.vec_id, round({_COSINE.format('a.embedding', 'b.embedding')}, 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_similarity(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following")
    )
    pairs = vectors.join(following, "vec_id")
    rows = similarity.add_cosine(pairs, "embedding", "following")
    return rows.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    "rank_candidates",
    f"""SELECT reference_id, candidate_id, similarity, row_number() OVER (
 PARTITION BY reference_id ORDER BY similarity DESC, candidate_id) AS rank
FROM (SELECT r.vec_id AS reference_id, c.vec_id AS candidate_id,
 round({_COSINE.format('r.embedding', 'c.embedding')}, 6) AS similarity
 FROM embeddings c JOIN (SELECT label, min_by(embedding, vec_id) AS embedding,
  min(vec_id) AS vec_id FROM embeddings GROUP BY label) r
 ON c.label = r.label AND c.vec_id <> r.vec_id) AS pairs""",
)
def rank_candidates(spark, sf_dir):
    """The first vector of each label is the reference for the others of it.

    The references are written out: joined straight from their grouping, the
    label would stay the partitioning and a hot label one task.
    """
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.groupBy("label").agg(
        F.min("vec_id").alias("reference_id"),
        F.min_by("embedding", "vec_id").alias("reference"),
    )
    references = stage(first, "references")
    pairs = vectors.join(references, "label").where("vec_id <> reference_id")
    pairs = similarity.add_cosine(pairs, "reference", "embedding").select(
        "reference_id",
        F.col("vec_id").alias("candidate_id"),
        F.round("similarity", 6).alias("similarity"),
    )
    return similarity.rank_candidates(pairs)


def _profile(column):
    """A text's share of each letter from a to z, as ``letter_profile`` gives it."""
    letters = f"list_transform(range(97, 123), lambda k: length({column}) - length(replace({column}, chr(CAST(k AS INTEGER)), '')))"
    return (
        f"(SELECT list_transform(l, lambda n: CAST(n / greatest(list_sum(l), 1) AS FLOAT))"
        f" FROM (SELECT {letters} AS l) AS counted)"
    )


_SIMILAR = (
    _SCORED[:-1]
    + f""",
profiled AS (SELECT *, {_profile('root_cause')} AS a, {_profile('expected_root_cause')} AS b,
 {_profile('recommendation')} AS c, {_profile('expected_recommendation')} AS d FROM scored),
compared AS (SELECT *, CASE WHEN is_valid THEN {_COSINE.format('a', 'b')} END AS root_cause_similarity,
 CASE WHEN is_valid THEN {_COSINE.format('c', 'd')} END AS recommendation_similarity FROM profiled)
"""
)


def similar(spark, sf_dir):
    """Similarity of what the models wrote to what was expected, from the texts."""
    return similarity.text_similarity(scored(spark, sf_dir), letter_profile())


@query(
    "field_similarity",
    _SIMILAR
    + """SELECT response_id, round(root_cause_similarity, 6) AS root_cause_similarity,
 round(recommendation_similarity, 6) AS recommendation_similarity FROM compared""",
)
def field_similarity(spark, sf_dir):
    return similar(spark, sf_dir).select(
        "response_id",
        F.round("root_cause_similarity", 6).alias("root_cause_similarity"),
        F.round("recommendation_similarity", 6).alias("recommendation_similarity"),
    )


@query("strip_fence", _JUDGED + "SELECT response_id, answer FROM unfenced")
def strip_fence(spark, sf_dir):
    from gradeloom.functions import judge

    rows = fixture(spark, sf_dir, "judge_answers")
    answer = judge.strip_fence(F.col("judge_response"))
    return rows.select("response_id", answer.alias("answer"))


def judged(spark, sf_dir):
    return judging.parse_judge(fixture(spark, sf_dir, "judge_answers"))


_FLAGS = ", ".join(f"CASE WHEN is_read THEN {f} END AS {f}" for f in C.JUDGE_FLAGS)


@query(
    "parse_judge",
    _JUDGED
    + f"""SELECT response_id, {_FLAGS},
 CASE WHEN is_read THEN explanation END AS explanation FROM judged""",
)
def parse_judge(spark, sf_dir):
    return judged(spark, sf_dir).select("response_id", "judge_result.*")


@query("validate_judge", _JUDGED + "SELECT response_id, is_read AS is_valid FROM judged")
def validate_judge(spark, sf_dir):
    valid = F.col("judge_result").isNotNull().alias("is_valid")
    return judged(spark, sf_dir).select("response_id", valid)


@query(
    "judge_scores",
    _JUDGED + "SELECT response_id, root_cause_score, recommendation_score FROM judged",
)
def judge_scores(spark, sf_dir):
    rows = judging.judge_scores(judged(spark, sf_dir))
    return rows.select("response_id", "root_cause_score", "recommendation_score")


@query(
    "score_cases",
    _SCORED
    + "SELECT response_id, case_id, model, category, expected_category, category_correct FROM scored",
)
def score_cases(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "response_id", "case_id", "model", "category", "expected_category",
        "category_correct",
    )


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


@query(
    "category_accuracy",
    _SCORED
    + """SELECT model, count(*) AS cases,
 round(avg(CAST(category_correct AS DOUBLE)) * 100, 6) AS category_accuracy
FROM scored GROUP BY model""",
)
def category_accuracy(spark, sf_dir):
    rows = responses.extract_category(fixture(spark, sf_dir, "responses"))
    rows = evaluation.score_cases(rows, fixture(spark, sf_dir, "eval_cases"))
    return _rounded(evaluation.category_accuracy(rows), "category_accuracy")


@query(
    "gated_category_accuracy",
    _SCORED
    + """SELECT model, count(*) AS cases,
 round(avg(CASE WHEN is_valid AND category_correct THEN 1.0 ELSE 0.0 END) * 100, 6)
  AS category_accuracy FROM scored GROUP BY model""",
)
def gated_category_accuracy(spark, sf_dir):
    rows = evaluation.gated_category_accuracy(scored(spark, sf_dir))
    return _rounded(rows, "category_accuracy")


@query(
    "structure_validity",
    _SCORED
    + """SELECT model, count(*) AS cases,
 round(avg(CAST(is_valid AS DOUBLE)) * 100, 6) AS structure_validity
FROM scored GROUP BY model""",
)
def structure_validity(spark, sf_dir):
    rows = evaluation.structure_validity(scored(spark, sf_dir))
    return _rounded(rows, "structure_validity")


_MEANS = ["avg_root_cause_similarity", "avg_recommendation_similarity"]


@query(
    "mean_similarity",
    _SIMILAR
    + """SELECT model,
 round(coalesce(avg(root_cause_similarity), 0), 6) AS avg_root_cause_similarity,
 round(coalesce(avg(recommendation_similarity), 0), 6) AS avg_recommendation_similarity
FROM compared GROUP BY model""",
)
def mean_similarity(spark, sf_dir):
    return _rounded(evaluation.mean_similarity(similar(spark, sf_dir)), *_MEANS)


_SIMILARITY_SUMMARY = """SELECT model,
 avg(CAST(category_correct AS DOUBLE)) * 100 AS category_accuracy,
 avg(CAST(is_valid AS DOUBLE)) * 100 AS structure_validity,
 coalesce(avg(root_cause_similarity), 0.0) AS avg_root_cause_similarity,
 coalesce(avg(recommendation_similarity), 0.0) AS avg_recommendation_similarity
 FROM compared GROUP BY model"""
_SIMILARITY_METRICS = [
    "category_accuracy", "structure_validity", "avg_root_cause_similarity",
    "avg_recommendation_similarity",
]


@query(
    "similarity_summary",
    _SIMILAR
    + "SELECT model, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in _SIMILARITY_METRICS)
    + f" FROM ({_SIMILARITY_SUMMARY}) AS s",
)
def similarity_summary(spark, sf_dir):
    rows = evaluation.similarity_summary(similar(spark, sf_dir))
    return _rounded(rows, *_SIMILARITY_METRICS)


@query(
    "similarity_comparison",
    _SIMILAR
    + "SELECT metric, round(base, 4) AS base, round(tuned, 4) AS tuned FROM ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, max({m}) FILTER (WHERE model = 'base') AS base, "
        f"max({m}) FILTER (WHERE model = 'tuned') AS tuned FROM ({_SIMILARITY_SUMMARY}) AS s"
        for m in _SIMILARITY_METRICS
    )
    + ") AS c",
)
def similarity_comparison(spark, sf_dir):
    summary = evaluation.similarity_summary(similar(spark, sf_dir))
    rows = evaluation.metric_comparison(summary, "base", "tuned")
    return rows.select("metric", F.round("base", 4).alias("base"), F.round("tuned", 4).alias("tuned"))


@query(
    "mean_judge_score",
    _JUDGED
    + """SELECT model, round(coalesce(avg(root_cause_score), 0), 6) AS avg_root_cause_score,
 round(coalesce(avg(recommendation_score), 0), 6) AS avg_recommendation_score
FROM judged GROUP BY model""",
)
def mean_judge_score(spark, sf_dir):
    rows = evaluation.mean_judge_score(judging.judge_scores(judged(spark, sf_dir)))
    return _rounded(rows, "avg_root_cause_score", "avg_recommendation_score")


_REPORT = (
    duckdb_ctes("responses", "eval_cases", "judge_answers")[:-1] + ",\n"
    + S.ANALYSED[:-1] + ",\n" + S.SCORED[:-1] + ",\n"
    + S.judge_ctes("judge_answers", "judge_response")[:-1]
    + """,
report AS (SELECT s.*, j.root_cause_score, j.recommendation_score
 FROM scored s JOIN judged j ON s.response_id = j.response_id)
"""
)


def report(spark, sf_dir):
    scores = judging.judge_scores(judged(spark, sf_dir)).select(
        "response_id", "root_cause_score", "recommendation_score"
    )
    return scored(spark, sf_dir).join(scores, "response_id")


@query(
    "case_report",
    _REPORT
    + """SELECT case_id, model, input, response, expected_category, category, category_correct,
 is_valid, expected_root_cause, root_cause, expected_recommendation, recommendation,
 root_cause_score, recommendation_score FROM report""",
)
def case_report(spark, sf_dir):
    return evaluation.case_report(report(spark, sf_dir))


@query(
    "accuracy_with_missing_answers",
    _SCORED
    + """SELECT model, count(*) AS cases,
 round(avg(CASE WHEN case_id % 4 <> 1 AND category_correct THEN 1.0 ELSE 0.0 END) * 100, 6)
  AS category_accuracy FROM scored GROUP BY model""",
)
def accuracy_with_missing_answers(spark, sf_dir):
    """A quarter of the cases has no answer; as many answers have no case."""
    rows = responses.extract_category(fixture(spark, sf_dir, "responses"))
    lost = F.col("case_id") % 4 == 1
    rows = rows.withColumn("case_id", F.when(lost, -F.col("case_id")).otherwise(F.col("case_id")))
    rows = evaluation.score_cases(rows, fixture(spark, sf_dir, "eval_cases"))
    return _rounded(evaluation.category_accuracy(rows), "category_accuracy")


_SUMMARY = """SELECT model,
 avg(CAST(category_correct AS DOUBLE)) * 100 AS category_accuracy,
 avg(CAST(is_valid AS DOUBLE)) * 100 AS structure_validity,
 coalesce(avg(root_cause_score), 0.0) AS avg_root_cause_score,
 coalesce(avg(recommendation_score), 0.0) AS avg_recommendation_score
 FROM report GROUP BY model"""


@query(
    "model_summary",
    _REPORT
    + "SELECT model, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in evaluation.METRICS)
    + f" FROM ({_SUMMARY}) AS s",
)
def model_summary(spark, sf_dir):
    rows = evaluation.model_summary(report(spark, sf_dir))
    return _rounded(rows, *evaluation.METRICS)


@query(
    "side_by_side",
    duckdb_ctes("responses")
    + """SELECT case_id, max(response) FILTER (WHERE model = 'base') AS base,
 max(response) FILTER (WHERE model = 'tuned') AS tuned FROM responses GROUP BY case_id""",
)
def side_by_side(spark, sf_dir):
    return evaluation.side_by_side(fixture(spark, sf_dir, "responses"), MODELS)


COMPARISON = "SELECT metric, round(base, 2) AS base, round(tuned, 2) AS tuned, round(CASE WHEN base = 0 THEN NULL ELSE (1 - tuned / base) * 100 END, 2) AS reduction_percent FROM ({0}) AS c"


def comparison_sql(summary):
    arms = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, max({m}) FILTER (WHERE model = 'base') AS base, "
        f"max({m}) FILTER (WHERE model = 'tuned') AS tuned FROM ({summary}) AS s"
        for m in evaluation.METRICS
    )
    return COMPARISON.format(arms)


def shown(comparison):
    """The comparison with two decimals, as it is printed."""
    names = ["base", "tuned", "reduction_percent"]
    return comparison.withColumns({name: F.round(name, 2) for name in names})


@query("metric_comparison", _REPORT + comparison_sql(_SUMMARY))
def metric_comparison(spark, sf_dir):
    summary = evaluation.model_summary(report(spark, sf_dir))
    return shown(evaluation.metric_comparison(summary, "base", "tuned"))
