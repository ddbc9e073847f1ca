import json

import pytest
from hypothesis import given, strategies as st

from gradeloom import constants as C
from gradeloom.operators import judging
from test_text import ONCE

GOOD = {
    "root_cause_correct": True,
    "root_cause_has_unsupported_claim": False,
    "recommendation_appropriate": True,
    "recommendation_complete": False,
    "explanation": "A sentence that is long enough.",
}
PLAIN = json.dumps(GOOD)
FENCE = C.CODE_FENCE


def changed(**values):
    return json.dumps({**GOOD, **values})


GOLDEN = [
    (PLAIN, True),
    (f"{FENCE}json\n{PLAIN}\n{FENCE}", True),
    (f"{FENCE}json\n{PLAIN}", True),
    (f"{FENCE}\n{PLAIN}\n{FENCE}", False),
    (f"{FENCE}\n{PLAIN}", True),
    (f"{FENCE}JSON\n{PLAIN}\n{FENCE}", False),
    (f"Sure: {PLAIN}", False),
    (f"{PLAIN} Done.", False),
    (f"{PLAIN}{PLAIN}", False),
    (f"[{PLAIN}]", False),
    (PLAIN + "}", False),
    (PLAIN[:-1], False),
    (PLAIN + ',"k":1', False),
    (PLAIN + ',"k":0,"x":{}', False),
    (PLAIN.replace('"', "'"), False),
    (f"\n \t\u00a0{PLAIN}\u2003\n", True),
    (changed(explanation="x" * 19), False),
    (changed(explanation="x" * 20), True),
    (changed(explanation="é" * 20), True),
    (changed(explanation=12345678901234567890), False),
    (changed(explanation=None), False),
    (changed(explanation={"a": "b" * 30}), False),
    (changed(root_cause_correct=None), False),
    (changed(root_cause_correct="yes"), True),
    (changed(root_cause_correct="On"), True),
    (changed(root_cause_correct="maybe"), False),
    (changed(root_cause_correct=" true"), False),
    (changed(root_cause_correct=1), True),
    (changed(root_cause_correct=1.0), True),
    (changed(root_cause_correct="1.0"), False),
    (changed(root_cause_correct=2), False),
    (changed(root_cause_correct=[True]), False),
    (changed(extra={"nested": [1, 2]}), True),
    ("{" + '"root_cause_correct": false,' + PLAIN[1:], True),
    ("null", False),
    ("", False),
    (None, False),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame(
        [(n, g[0]) for n, g in enumerate(GOLDEN)], "n int, judge_response string"
    )
    scored = judging.judge_scores(judging.parse_judge(rows))
    return {r["n"]: r for r in scored.collect()}


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden(parsed, n):
    result = parsed[n]["judge_result"]
    assert (result is not None) == GOLDEN[n][1]
    if result is not None:
        assert result["root_cause_correct"] is True
        assert result["recommendation_complete"] is False
        assert parsed[n]["root_cause_score"] == 2
        assert parsed[n]["recommendation_score"] == 1
    else:
        assert parsed[n]["root_cause_score"] is None


def test_scores(spark):
    flags = [(a, b, c, d) for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)]
    texts = [
        json.dumps(dict(zip(C.JUDGE_FLAGS, map(bool, f)), explanation="x" * 20)) for f in flags
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, judge_response string")
    for row in judging.judge_scores(judging.parse_judge(rows)).collect():
        correct, unsupported, appropriate, complete = flags[row["n"]]
        assert row["root_cause_score"] == (0 if not correct else 1 if unsupported else 2)
        assert row["recommendation_score"] == (0 if not appropriate else 1 if not complete else 2)


def reads_as_json(answer):
    try:
        return isinstance(json.loads(answer), dict)
    except ValueError:
        return False


@ONCE
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["", " ", "x", "{", FENCE, FENCE + "json\n", "[", "\n"]),
            st.sampled_from([PLAIN, PLAIN[:-1], PLAIN.replace(",", ",,", 1), "{}"]),
            st.sampled_from(["", " ", "x", "}", "\n" + FENCE, ",", "]", '"']),
        ).map("".join),
        min_size=60,
        max_size=60,
    )
)
def test_strictness(spark, answers):
    rows = spark.createDataFrame(list(enumerate(answers)), "n int, judge_response string")
    for row in judging.parse_judge(rows).collect():
        answer = row["judge_response"].strip()
        if answer.startswith(FENCE):
            answer = answer.replace(FENCE + "json", "", 1).replace(FENCE, "", 1).strip()
        valid = reads_as_json(answer) and "explanation" in json.loads(answer)
        assert (row["judge_result"] is not None) == valid
