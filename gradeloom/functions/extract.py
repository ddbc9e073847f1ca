"""Structured answers out of free response text.

The label ladders take text that is already in upper case and the section
finders take the text with its lower-case copy, so that a job folds each
response once and reads it many times.
"""

from functools import reduce

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions.text import strip


def _contains_any(text, phrases):
    return reduce(
        lambda left, right: left | right,
        [F.contains(text, F.lit(phrase)) for phrase in phrases],
    )


def _first_match(rules):
    ladder = None
    for condition, label in rules:
        ladder = (F if ladder is None else ladder).when(condition, label)
    return ladder


def canonical_label(upper_text):
    """First of the six labels, in list order, that the text contains."""
    return _first_match(
        (F.contains(upper_text, F.lit(label)), label) for label in C.CATEGORIES
    )


def phrase_label(upper_text):
    """First label, in list order, that has one of its phrases in the text."""
    return _first_match(
        (_contains_any(upper_text, phrases), label)
        for label, phrases in C.CATEGORY_PHRASES.items()
    )


def category(upper_text):
    """A written label wins over any phrase; null when neither is there."""
    return F.coalesce(canonical_label(upper_text), phrase_label(upper_text))


def section_start(lower_text, markers):
    """1-based position after the first marker found, null without one."""
    return _first_match(
        (
            F.instr(lower_text, marker) > 0,
            F.instr(lower_text, marker) + F.lit(len(marker)),
        )
        for marker in markers
    )


def tail(text, start):
    """Text from ``start`` to the end."""
    return F.substring(text, start, F.length(text))


def root_cause_of(section):
    """The section up to the next heading; empty when there is no section."""
    stop = F.instr(F.lower(section), C.SECTION_STOP)
    body = F.when(stop > 0, F.substring(section, F.lit(1), stop - 1)).otherwise(section)
    return F.coalesce(strip(body), F.lit(""))


def recommendation_of(section):
    """The whole section; empty when there is none."""
    return F.coalesce(strip(section), F.lit(""))


def root_cause(text):
    start = section_start(F.lower(text), C.ROOT_CAUSE_MARKERS)
    return root_cause_of(tail(text, start))


def recommendation(text):
    start = section_start(F.lower(text), C.RECOMMENDATION_MARKERS)
    return recommendation_of(tail(text, start))


def is_valid_structure(category_col, root_cause_col, recommendation_col):
    """All three parts are there and long enough."""

    def at_least(column, size):
        return F.coalesce(F.length(column), F.lit(0)) >= size

    return (
        at_least(category_col, C.MIN_CATEGORY_CHARS)
        & at_least(root_cause_col, C.MIN_ROOT_CAUSE_CHARS)
        & at_least(recommendation_col, C.MIN_RECOMMENDATION_CHARS)
    )


def preview(text, size):
    return F.substring(text, 1, size)
