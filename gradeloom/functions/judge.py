"""Strict reading of a judge's answer."""

from functools import reduce

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions.text import strip

RESULT = (
    "struct<" + ",".join(f"{flag}:boolean" for flag in C.JUDGE_FLAGS)
    + ",explanation:string>"
)
_RAW = (
    "v struct<" + ",".join(f"{name}:variant" for name in C.JUDGE_FLAGS + ["explanation"])
    + ">, k int"
)


def _remove_first(text, piece):
    return F.regexp_replace(text, f"(?s)^(.*?){piece}", "$1")


def unfence(body):
    """Drop the opening code fence of a text without outer whitespace.

    The first json fence goes and then the first fence that is left, which is the
    closing one unless the fence named no language.
    """
    opened = _remove_first(_remove_first(body, C.CODE_FENCE + "json"), C.CODE_FENCE)
    return F.when(body.startswith(C.CODE_FENCE), strip(opened)).otherwise(body)


def strip_fence(text):
    return unfence(strip(text))


def wrap(text):
    """The answer as one value inside an object, with a marker after it.

    The JSON readers stop at the end of the first value and ignore what follows.
    Here trailing text breaks the wrapper, so that only one complete value passes.
    """
    return F.concat(F.lit('{"v":'), text, F.lit(',"k":0}'))


def read_wrapped(wrapped):
    """``(v: the fields as variants, k: 0)`` of a wrapped answer."""
    return F.from_json(wrapped, _RAW, {"allowSingleQuotes": "false"})


def is_complete(text, wrapped, parsed):
    """The answer was one JSON object and nothing else."""
    return (
        text.startswith("{")
        & F.coalesce(parsed["k"] == 0, F.lit(False))
        & F.coalesce(
            F.json_object_keys(wrapped) == F.array(F.lit("v"), F.lit("k")), F.lit(False)
        )
    )


def _flag(value):
    """A boolean, the numbers 0 and 1, or one of the accepted words; else null."""
    kind = F.schema_of_variant(value)
    word = F.lower(F.try_variant_get(value, "$", "string"))
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(
            kind == "STRING",
            F.when(word.isin(C.TRUE_WORDS), F.lit(True)).when(
                word.isin(C.FALSE_WORDS), F.lit(False)
            ),
        )
        .when(number == 1, F.lit(True))
        .when(number == 0, F.lit(False))
    )


def fields(parsed):
    """Typed fields of a parsed answer; a field of the wrong kind is null."""
    explanation = parsed["v"]["explanation"]
    return F.struct(
        *[_flag(parsed["v"][flag]).alias(flag) for flag in C.JUDGE_FLAGS],
        F.when(
            F.schema_of_variant(explanation) == "STRING",
            F.try_variant_get(explanation, "$", "string"),
        ).alias("explanation"),
    )


def validated(result):
    """The result when all flags are there and the explanation is long enough."""
    rules = [result[flag].isNotNull() for flag in C.JUDGE_FLAGS]
    rules.append(
        F.coalesce(F.length(result["explanation"]), F.lit(0)) >= C.MIN_EXPLANATION_CHARS
    )
    return F.when(reduce(lambda a, b: a & b, rules), result)


def root_cause_score(result):
    return (
        F.when(~result["root_cause_correct"], 0)
        .when(result["root_cause_has_unsupported_claim"], 1)
        .when(result["root_cause_correct"], 2)
    )


def recommendation_score(result):
    return (
        F.when(~result["recommendation_appropriate"], 0)
        .when(~result["recommendation_complete"], 1)
        .when(result["recommendation_appropriate"], 2)
    )
