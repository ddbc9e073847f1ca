"""Loss masks: which tokens of a conversation are trained on."""

from pyspark.sql import functions as F

from gradeloom.functions import tokens as T


def add_loss_mask(df, marker, ids="ids", strict=False, end_marker=None):
    """Add ``answer_start``, ``labels`` and ``has_answer``.

    ``marker`` lists the ids of the assistant marker. Everything up to and with
    its last occurrence is ignored; all tokens after it are trained on, a closing
    tag and later turns included. With ``end_marker`` (an id) the tokens after
    the first closing tag behind the answer are ignored as well. A row without a
    marker has null labels; ``strict`` fails the job on one instead.
    """
    start = T.last_marker_end(F.col(ids), [F.lit(part) for part in marker])
    if strict:
        message = F.lit("a sequence has no assistant turn to train on")
        start = F.when(start.isNotNull(), start).otherwise(
            F.raise_error(message).cast("int")
        )
    df = df.withColumn("answer_start", start)
    stop = None
    if end_marker is not None:
        rest = F.slice(F.col(ids), F.col("answer_start") + 1, F.size(ids))
        place = F.array_position(rest, F.lit(end_marker).cast("long"))
        df = df.withColumn(
            "_stop",
            F.when(place > 0, F.col("answer_start") + place).otherwise(F.size(ids)),
        )
        stop = F.col("_stop")
    labels = T.mask_labels(F.col(ids), F.col("answer_start"), stop)
    return (
        df.withColumn("labels", labels)
        .withColumn("has_answer", F.col("answer_start").isNotNull())
        .drop("_stop")
    )
