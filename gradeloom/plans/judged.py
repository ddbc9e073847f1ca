"""Judged comparison of models, from held-out cases to the final table."""

from functools import reduce

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions import chat
from gradeloom.operators import (
    answers as answers_store,
    evaluation,
    inference,
    judging,
    quality,
    responses,
)
from gradeloom.sources.staging import stage


def answer_cases(cases, models, store=None):
    """``(case_id, input, model, response)`` of every model, written out once.

    With ``store`` (a folder) the answers are kept there, and a later run generates only
    those that are not there yet.
    """
    messages = chat.analysis_messages(F.col("input"))
    prompts = cases.select(
        "case_id", "input", chat.render(messages, generation_prompt=True).alias("prompt")
    )
    cap = C.MAX_NEW_TOKENS["quality"]
    answers = []
    for name, factory in models.items():
        if store is None:
            rows = inference.generate(prompts, "prompt", factory, max_new_tokens=cap)
        else:
            rows = answers_store.generate_stored(prompts, "prompt", factory, name, store, max_new_tokens=cap)
        answers.append(rows.select("case_id", "input", F.lit(name).alias("model"), "response"))
    return stage(reduce(lambda a, b: a.unionAll(b), answers), "responses")


def judge_cases(scored, judge_factory, store=None):
    """Add the judge's answer, its reading and both scores, written out once.

    With ``store`` the judge's answers are kept there, as the model ``judge``.
    """
    prompt = chat.judge_prompt(
        F.col("input"),
        F.col("expected_root_cause"),
        F.col("root_cause"),
        F.col("expected_recommendation"),
        F.col("recommendation"),
    )
    asked = scored.withColumn(
        "judge_prompt",
        chat.render(chat.judge_messages(prompt), generation_prompt=True),
    )
    cap = C.MAX_NEW_TOKENS["judge"]
    if store is None:
        answered = inference.generate(asked, "judge_prompt", judge_factory, "judge_response", cap)
    else:
        # Written out: the prompts are read once a part.
        answered = answers_store.generate_stored(
            stage(asked, "asked"), "judge_prompt", judge_factory, "judge", store, "judge_response", cap
        )
    answered = stage(answered.drop("judge_prompt"), "judged")
    return judging.judge_scores(judging.parse_judge(answered))


def judged_evaluation(cases, models, judge_factory, store=None):
    """One row per case and model with every field, check and score."""
    analyses = responses.extract_analysis(answer_cases(cases, models, store))
    analyses = quality.add_structure_validity(analyses)
    scored = evaluation.score_cases(analyses, cases)
    return judge_cases(scored, judge_factory, store)


def comparison(judged, base, tuned):
    return evaluation.metric_comparison(evaluation.model_summary(judged), base, tuned)
