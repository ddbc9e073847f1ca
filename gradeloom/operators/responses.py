"""Model responses to structured answers."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions import extract


def extract_analysis(df, response="response"):
    """Add ``category``, ``root_cause`` and ``recommendation``.

    Each step is a column of its own, so that a response is folded to upper and
    lower case once however many rules read it.
    """
    text = F.col(response)
    steps = ["_upper", "_lower", "_root_start", "_advice_start", "_root", "_advice"]
    return (
        df.withColumns({"_upper": F.upper(text), "_lower": F.lower(text)})
        .withColumns(
            {
                "_root_start": extract.section_start(
                    F.col("_lower"), C.ROOT_CAUSE_MARKERS
                ),
                "_advice_start": extract.section_start(
                    F.col("_lower"), C.RECOMMENDATION_MARKERS
                ),
            }
        )
        .withColumns(
            {
                "_root": extract.tail(text, F.col("_root_start")),
                "_advice": extract.tail(text, F.col("_advice_start")),
            }
        )
        .withColumns(
            {
                "category": extract.category(F.col("_upper")),
                "root_cause": extract.root_cause_of(F.col("_root")),
                "recommendation": extract.recommendation_of(F.col("_advice")),
            }
        )
        .drop(*steps)
    )


def extract_category(df, response="response"):
    """Add ``canonical_label``, ``phrase_label`` and the ``category`` they give."""
    upper = F.col("_upper")
    return (
        df.withColumn("_upper", F.upper(response))
        .withColumns(
            {
                "canonical_label": extract.canonical_label(upper),
                "phrase_label": extract.phrase_label(upper),
            }
        )
        .withColumn("category", F.coalesce("canonical_label", "phrase_label"))
        .drop("_upper")
    )
