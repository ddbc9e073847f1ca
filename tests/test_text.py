import ast
import json
import re
import string
import unicodedata

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gradeloom.constants import WHITESPACE
from gradeloom.functions import text

# Characters of an old Unicode version: newer ones are known to Python and may be
# unassigned, and so escaped, for the JVM.
OLD = unicodedata.ucd_3_2_0
CHARACTERS = st.characters(exclude_categories=["Cs"]).filter(
    lambda c: OLD.category(c) != "Cn"
)
ANY_TEXT = st.text(CHARACTERS, max_size=30)
TRICKY = st.text("ab'\"\\\n\r\t\x00\x1f \x85\xa0\u200b\u2028é😀\U000e0001", max_size=12)
ONCE = settings(
    max_examples=8, deadline=None, suppress_health_check=list(HealthCheck)
)


def values(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    out = rows.select("n", expression(F.col("t")).alias("v")).orderBy("n").collect()
    return [row["v"] for row in out]


@ONCE
@given(st.lists(st.one_of(ANY_TEXT, TRICKY), min_size=60, max_size=60))
def test_string_literal_is_the_python_literal(spark, texts):
    found = values(spark, texts, text.string_literal)
    assert [ast.literal_eval(v) for v in found] == texts
    assert found == [repr(t) for t in texts]


@ONCE
@given(st.lists(st.text(WHITESPACE + "ab\u200b", max_size=9), min_size=60, max_size=60))
def test_strip_and_words(spark, texts):
    assert values(spark, texts, text.strip) == [t.strip() for t in texts]
    assert values(spark, texts, text.words) == [t.split() for t in texts]


def by_steps(value):
    for pattern in (r"[*#`]", r"[^a-z0-9\s]", r"\s+"):
        value = re.sub(pattern, " ", value.lower())
    return value.strip()


@ONCE
@given(st.lists(ANY_TEXT, min_size=60, max_size=60))
def test_normalize_text(spark, texts):
    assert values(spark, texts, text.normalize_text) == [by_steps(t) for t in texts]


def test_word_overlap(spark):
    pairs = [
        ("The quick fox", "a QUICK, quick fox!", 2 / 3),
        ("", "anything", 0.0),
        ("***", "anything", 0.0),
        ("same words", "same words", 1.0),
        ("one two", "", 0.0),
        ("a a b", "b", 0.5),
    ]
    rows = spark.createDataFrame(pairs, "r string, p string, e double")
    overlap = text.word_overlap(F.col("r"), F.col("p"))
    for row in rows.select("e", overlap.alias("v")).collect():
        assert row["v"] == row["e"]


def test_record_literal(spark):
    record = {"category": "X", "root_cause": "it's", "recommendation": None}
    rows = spark.createDataFrame(
        [tuple(record.values())], "category string, root_cause string, recommendation string"
    )
    fields = [(name, F.col(name)) for name in record]
    assert rows.select(text.record_literal(fields)).first()[0] == str(record)


def test_spaced_json(spark):
    documents = [
        {"a": 1, "b": [1, 2, {"c": "x, y: z"}]},
        {"quote": 'he said "a,b:c"', "slash": "c:\\d,", "empty": {}},
        {"long": string.printable * 200, "n": -1.5, "t": True, "none": None},
    ]
    compact = [json.dumps(d, separators=(",", ":"), ensure_ascii=False) for d in documents]
    spaced = [json.dumps(d, ensure_ascii=False) for d in documents]
    assert values(spark, compact, text.spaced_json) == spaced
