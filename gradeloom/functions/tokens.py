"""Token expressions over one row."""

from functools import reduce

from pyspark.sql import functions as F

from gradeloom import constants as C

# Special tokens, words with the blank before them, and any other character on
# its own: the tokens of a text, joined, are the text again.
TOKEN_PATTERN = r"<\|[a-z_]+\|>| ?[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_]"
ASSISTANT_MARKER = ["<|im_start|>", "assistant", "\n"]


def tokenize(text):
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def last_marker_end(ids, marker):
    """0-based position after the last run of ``marker`` in ``ids``, or null.

    ``marker`` is a list of columns: the ids (or tokens) of the assistant marker.
    """

    def place(value, at):
        following = [
            F.get(ids, at + F.lit(k)) == part for k, part in enumerate(marker) if k
        ]
        begins = reduce(lambda a, b: a & b, [value == marker[0], *following])
        return F.when(begins, at + F.lit(len(marker)))

    return F.array_max(F.transform(ids, place))


def mask_labels(ids, start, stop=None):
    """``-100`` before ``start`` and, if given, from ``stop`` on; ids between."""
    ignored = F.lit(C.IGNORE_LABEL)

    def label(value, at):
        outside = at < start
        if stop is not None:
            outside = outside | (at >= stop)
        return F.when(outside, ignored).otherwise(value)

    return F.when(start.isNotNull(), F.transform(ids, label))


def ignored_count(labels):
    return F.size(F.filter(labels, lambda label: label == C.IGNORE_LABEL))


def completion_slice(output_ids, input_ids):
    """What a model added after its input."""
    return F.slice(
        output_ids, F.size(input_ids) + 1, F.size(output_ids) - F.size(input_ids)
    )


def truncate(ids, size=C.MAX_LENGTH):
    return F.slice(ids, 1, size)
