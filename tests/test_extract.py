import pytest
from hypothesis import given, strategies as st

from gradeloom import constants as C
from gradeloom.operators import quality, responses
from test_text import ONCE

GOLDEN = [
    ("DATA_ERROR then SCHEMA_ERROR", "SCHEMA_ERROR", "", ""),
    ("schema is fine, TIMEOUT_ERROR", "TIMEOUT_ERROR", "", ""),
    ("AUTHENTICATION_ERROR", "AUTH_ERROR", "", ""),
    ("TIMEOUT", "TIMEOUT_ERROR", "", ""),
    ("DATA_QUALITY_ERROR", None, "", ""),
    ("DUPLICATE_EVENT", None, "", ""),
    ("TRANSFORMATION_ERROR", None, "", ""),
    ("UNKNOWN_ERROR", None, "", ""),
    ("the diameter check failed", "AUTH_ERROR", "", ""),
    ("", None, "", ""),
    ("**Root Cause:** a**Recommended Action:** b", None, "** a**", "** b"),
    ("The root cause is X", None, "is X", ""),
    ("Recommended Action: b\nRoot cause: a", None, "a", "b\nRoot cause: a"),
    ("root cause first. Root cause:\u00a0 second \u2003", None, "second", ""),
    (None, None, "", ""),
]


@pytest.fixture(scope="module")
def analysed(spark):
    rows = spark.createDataFrame(
        [(n, g[0]) for n, g in enumerate(GOLDEN)], "n int, response string"
    )
    return {r["n"]: r for r in responses.extract_analysis(rows).collect()}


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden(analysed, n):
    row = analysed[n]
    found = (row["category"], row["root_cause"], row["recommendation"])
    assert found == GOLDEN[n][1:]


PIECES = [label.lower() for label in C.CATEGORIES]
PIECES += [p.title() for phrases in C.CATEGORY_PHRASES.values() for p in phrases]
PIECES += ["Root Cause:", "root cause", "RECOMMENDED ACTION", "Recommended action: "]
PIECES += ["word", " ", "\n", "**", "x"]


def expected(response):
    """The rules once more, over plain strings."""
    upper, lower = response.upper(), response.lower()
    rules = [(label, [label]) for label in C.CATEGORIES] + list(C.CATEGORY_PHRASES.items())
    category = next((c for c, ps in rules if any(p in upper for p in ps)), None)

    def after(markers):
        marker = next((m for m in markers if m in lower), None)
        return "" if marker is None else response[lower.index(marker) + len(marker):]

    cause = after(C.ROOT_CAUSE_MARKERS)
    stop = cause.lower().find(C.SECTION_STOP)
    cause = (cause if stop < 0 else cause[:stop]).strip()
    return category, cause, after(C.RECOMMENDATION_MARKERS).strip()


@ONCE
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=7).map("".join), min_size=80, max_size=80))
def test_against_plain_rules(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, response string")
    for row in responses.extract_analysis(rows).collect():
        found = (row["category"], row["root_cause"], row["recommendation"])
        assert found == expected(row["response"])
        assert row["category"] in [None, *C.CATEGORIES]


def test_offsets_shift_with_the_lower_case(spark):
    # A capital I with a dot is two characters in lower case, so what follows a
    # marker is read one place further on; that is how the rule is defined.
    rows = spark.createDataFrame([("İ root cause: abc",)], "response string")
    assert responses.extract_analysis(rows).first()["root_cause"] == "abc"
    assert expected("İ root cause: abc")[1] == "abc"


def test_structure_validity(spark):
    twenty, nineteen = "x" * 20, "é" * 19
    cases = [
        ("ABC", twenty, twenty, True),
        ("AB", twenty, twenty, False),
        (None, twenty, twenty, False),
        ("ABC", nineteen, twenty, False),
        ("ABC", twenty, nineteen, False),
        ("ABC", "é" * 20, "😀" * 20, True),
    ]
    rows = spark.createDataFrame(
        cases, "category string, root_cause string, recommendation string, expected boolean"
    )
    for row in quality.add_structure_validity(rows).collect():
        assert row["is_valid"] == row["expected"]


def test_labels_and_category_agree(spark):
    rows = spark.createDataFrame([("quota; timeout_error",)], "response string")
    row = responses.extract_category(rows).first()
    assert row["canonical_label"] == row["category"] == "TIMEOUT_ERROR"
    assert row["phrase_label"] == "TIMEOUT_ERROR"
