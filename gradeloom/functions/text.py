"""Text expressions."""

from pyspark.sql import functions as F

from gradeloom.constants import WHITESPACE

# Other characters that the literal form writes as an escape: control, format,
# surrogate, private, unassigned, and every separator but the plain space.
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def strip(text):
    """Remove whitespace of any kind from both ends (``trim`` knows spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text):
    """Words between runs of whitespace; never an empty word."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda word: word != "")


def normalize_text(text):
    """Lower case, everything but ``a-z0-9`` to a single space, ends trimmed.

    Removing markdown, punctuation and repeated blanks one after the other leaves
    exactly the runs of ``a-z0-9`` parted by one space, so one pass does it.
    """
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def word_set(text):
    """Distinct words of the normalised text."""
    return F.array_remove(F.array_distinct(F.split(normalize_text(text), " ")), "")


def word_hashes(text):
    """The distinct words as sorted 64-bit hashes, which are small to move and compare."""
    return F.sort_array(F.array_distinct(F.transform(word_set(text), lambda word: F.xxhash64(word))))


def overlap_of_sets(reference_words, predicted_words):
    """Share of the reference words found in the prediction; 0.0 without any."""
    found = F.size(F.array_intersect(reference_words, predicted_words))
    total = F.size(reference_words)
    return F.when(total > 0, found / total).otherwise(F.lit(0.0))


def word_overlap(reference, prediction):
    return overlap_of_sets(word_set(reference), word_set(prediction))


def _escape_unprintable(char):
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    return (
        F.when(~char.rlike(UNPRINTABLE), char)
        .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def string_literal(text):
    """A string as a Python literal: quoted and escaped."""
    escaped = text
    for raw, code in [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]:
        escaped = F.replace(escaped, F.lit(raw), F.lit(code))
    # Rare: only texts that hold such a character are taken apart.
    escaped = F.when(
        escaped.rlike(UNPRINTABLE),
        F.array_join(F.transform(F.split(escaped, ""), _escape_unprintable), ""),
    ).otherwise(escaped)
    double_quoted = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(double_quoted, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def record_literal(fields):
    """``{'name': 'value', ...}`` from ``[(name, column)]``; a null is ``None``."""
    pieces = [
        F.concat(
            F.lit(f"'{name}': "), F.coalesce(string_literal(value), F.lit("None"))
        )
        for name, value in fields
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}"))


def spaced_json(json_text):
    """Compact JSON with a space after each ``,`` and ``:`` outside strings."""
    pieces = F.regexp_extract_all(
        json_text, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]+'), F.lit(0)
    )
    spaced = F.transform(
        pieces,
        lambda piece: F.when(piece.startswith('"'), piece).otherwise(
            F.replace(
                F.replace(piece, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": ")
            )
        ),
    )
    return F.array_join(spaced, "")
