"""Jobs that call a model. The models here are small rules, which stand in for
a real one and have a counterpart in SQL."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.catalog import sql as S
from gradeloom.catalog.fixtures import duckdb_ctes, fixture, table
from gradeloom.catalog.models import letter_profile
from gradeloom.catalog.registry import query
from gradeloom.catalog.response_queries import comparison_sql, shown
from gradeloom.functions import chat
from gradeloom.operators import evaluation, inference
from gradeloom.plans import judged

FAILURE_MARK = "ETL Failure:\n"


def rule_model(labels=None):
    """A factory: answers with a label chosen by the length of the failure."""
    mark, end = FAILURE_MARK, C.IM_END

    def factory():
        def answer(prompt):
            failure = prompt.split(mark, 1)[1].split(end, 1)[0]
            label = labels[len(failure) % len(labels)] if labels else "No label"
            return (
                f"Category: {label}\nRoot cause: {failure}\n"
                f"Recommended action: Look into it and rerun: {failure}"
            )

        return lambda prompts, max_new_tokens: [answer(prompt) for prompt in prompts]

    return factory


def rule_judge():
    """A factory: grades by the digits in the prompt; some answers are prose."""

    def factory():
        def flag(value):
            return "true" if value else "false"

        def answer(prompt):
            failure = prompt.split("ETL FAILURE:\n", 1)[1].split("\n", 1)[0]
            if "5" in failure:
                return "I would say this is a good answer."
            return (
                '```json\n{"root_cause_correct": ' + flag("1" in failure)
                + ', "root_cause_has_unsupported_claim": ' + flag("2" in failure)
                + ', "recommendation_appropriate": ' + flag("3" not in failure)
                + ', "recommendation_complete": ' + flag("4" in failure)
                + ', "explanation": "Graded by the digits of the text."}\n```'
            )

        return lambda prompts, max_new_tokens: [answer(prompt) for prompt in prompts]

    return factory


def _answer_sql(label):
    return (
        f"'Category: ' || {label} || chr(10) || 'Root cause: ' || input || chr(10)"
        " || 'Recommended action: Look into it and rerun: ' || input"
    )


_LABELS = "(['" + "', '".join(C.CATEGORIES) + "'])[length(input) % 6 + 1]"


@query(
    "predict",
    duckdb_ctes("eval_cases")
    + f"SELECT case_id, {_answer_sql(_LABELS)} AS response FROM eval_cases",
)
def predict(spark, sf_dir):
    messages = chat.analysis_messages(F.col("input"))
    prompts = fixture(spark, sf_dir, "eval_cases").select(
        "case_id", chat.render(messages, generation_prompt=True).alias("prompt")
    )
    answered = inference.generate(prompts, "prompt", rule_model(C.CATEGORIES))
    return answered.select("case_id", "response")


_JUDGE_ANSWER = """CASE WHEN contains(input, '5') THEN 'I would say this is a good answer.'
 ELSE '```json' || chr(10) || '{"root_cause_correct": ' || CAST(contains(input, '1') AS VARCHAR)
 || ', "root_cause_has_unsupported_claim": ' || CAST(contains(input, '2') AS VARCHAR)
 || ', "recommendation_appropriate": ' || CAST(NOT contains(input, '3') AS VARCHAR)
 || ', "recommendation_complete": ' || CAST(contains(input, '4') AS VARCHAR)
 || ', "explanation": "Graded by the digits of the text."}' || chr(10) || '```' END"""


@query(
    "judge",
    duckdb_ctes("eval_cases")
    + f"SELECT case_id, {_JUDGE_ANSWER} AS judge_response FROM eval_cases",
)
def judge(spark, sf_dir):
    cases = fixture(spark, sf_dir, "eval_cases")
    cause, advice = F.col("expected_root_cause"), F.col("expected_recommendation")
    prompt = chat.judge_prompt(F.col("input"), cause, cause, advice, advice)
    messages = chat.judge_messages(prompt)
    prompts = cases.select(
        "case_id", chat.render(messages, generation_prompt=True).alias("prompt")
    )
    cap = C.MAX_NEW_TOKENS["judge"]
    answered = inference.generate(
        prompts, "prompt", rule_judge(), "judge_response", max_new_tokens=cap
    )
    return answered.select("case_id", "judge_response")


_LETTERS = " UNION ALL ".join(
    f"SELECT doc_id, {k} AS place, length(text) - length(replace(text, '{chr(97 + k)}', '')) AS n"
    " FROM documents"
    for k in range(26)
)


@query(
    "embed",
    f"""SELECT doc_id, place, round(CAST(CAST(n / CASE WHEN total = 0 THEN 1 ELSE total END AS FLOAT) AS DOUBLE), 5) AS share
FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total FROM ({_LETTERS}) AS l) AS t""",
)
def embed(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = inference.embed(documents, "text", letter_profile())
    flat = vectors.select("doc_id", F.posexplode_outer("embedding").alias("place", "share"))
    return flat.select("doc_id", "place", F.round(F.col("share").cast("double"), 5).alias("share"))


_EVALUATION = (
    duckdb_ctes("eval_cases")[:-1]
    + f""",
responses AS (SELECT case_id * 2 AS response_id, case_id, 'base' AS model,
  {_answer_sql("'No label'")} AS response FROM eval_cases
 UNION ALL SELECT case_id * 2 + 1, case_id, 'tuned', {_answer_sql(_LABELS)} FROM eval_cases),
"""
    + S.ANALYSED[:-1] + ",\n" + S.SCORED[:-1]
    + f""",
answers AS (SELECT response_id, {_JUDGE_ANSWER} AS judge_response FROM scored),
"""
    + S.judge_ctes("answers", "judge_response")[:-1]
    + """,
report AS (SELECT s.*, j.root_cause_score, j.recommendation_score
 FROM scored s JOIN judged j ON s.response_id = j.response_id)
"""
)


def evaluated(spark, sf_dir):
    cases = fixture(spark, sf_dir, "eval_cases")
    models = {"base": rule_model(), "tuned": rule_model(C.CATEGORIES)}
    return judged.judged_evaluation(cases, models, rule_judge())


@query(
    "judged_evaluation",
    _EVALUATION
    + """SELECT case_id, model, category, root_cause, recommendation, category_correct, is_valid,
 root_cause_score, recommendation_score FROM report""",
)
def judged_evaluation(spark, sf_dir):
    return evaluated(spark, sf_dir).select(
        "case_id", "model", "category", "root_cause", "recommendation",
        "category_correct", "is_valid", "root_cause_score", "recommendation_score",
    )


_SUMMARY = """SELECT model,
 avg(CAST(category_correct AS DOUBLE)) * 100 AS category_accuracy,
 avg(CAST(is_valid AS DOUBLE)) * 100 AS structure_validity,
 coalesce(avg(root_cause_score), 0.0) AS avg_root_cause_score,
 coalesce(avg(recommendation_score), 0.0) AS avg_recommendation_score
 FROM report GROUP BY model"""


@query("judged_comparison", _EVALUATION + comparison_sql(_SUMMARY))
def judged_comparison(spark, sf_dir):
    return shown(judged.comparison(evaluated(spark, sf_dir), "base", "tuned"))
