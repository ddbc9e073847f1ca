"""Training data, from raw examples to labelled token ids."""

from pyspark.sql import functions as F

from gradeloom.functions import tokens as T
from gradeloom.operators import (
    examples as E,
    masking,
    quality,
    splits,
    vocabulary as V,
)
from gradeloom.sources.staging import stage


def marker_ids(vocabulary):
    """Ids of the assistant marker's three tokens, -1 for one not in use."""
    rows = vocabulary.where(F.col("token").isin(T.ASSISTANT_MARKER)).collect()
    ids = {row["token"]: row["id"] for row in rows}
    return [ids.get(token, V.UNKNOWN_ID) for token in T.ASSISTANT_MARKER]


def checked(examples):
    """``(good, bad)``: bad rows keep their errors, nothing is thrown away."""
    rows = quality.add_errors(examples)
    return (
        rows.where(F.size("errors") == 0).drop("errors"),
        rows.where(F.size("errors") > 0).select("example_id", "errors"),
    )


def training_tokens(examples):
    """``(example_id, split, rendered, tokens)`` of good examples."""
    pairs = E.training_text(E.prompt_completion(examples))
    return (
        splits.split_by_hash(pairs)
        .select("example_id", "split", "rendered")
        .withColumn("tokens", T.tokenize(F.col("rendered")))
    )


def training_table(examples, max_length=None):
    """``(example_id, split, ids, labels)``; ids count the given examples' tokens."""
    rows = V.slice_items(training_tokens(examples).drop("rendered"), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    encoded = V.encode(rows, words)
    masked = masking.add_loss_mask(encoded, marker_ids(words))
    if max_length is not None:
        masked = masked.withColumns(
            {
                "ids": T.truncate(F.col("ids"), max_length),
                "labels": T.truncate(F.col("labels"), max_length),
            }
        )
    return masked.select("example_id", "split", "ids", "labels")
