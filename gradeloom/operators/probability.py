"""Token probabilities from logits.

Logits come as one array per position, which needs no shuffle at all, or in long
form with one row per candidate. A long group may be too large for one task and
is handled in slices of its candidate ids.
"""

from pyspark.sql import Window, functions as F

from gradeloom import constants as C
from gradeloom.functions.vectors import softmax

SLICE_CANDIDATES = 1_000_000


def add_probabilities(df, logits="logits"):
    """Add ``probabilities``, the softmax of a logit array."""
    return df.withColumn("probabilities", softmax(F.col(logits)))


def top_k(df, key, k=C.TOP_K, probabilities="probabilities"):
    """``(key, rank, candidate_id, probability)``; equal ones by candidate id."""
    ordered = F.sort_array(
        F.transform(
            probabilities,
            lambda p, at: F.struct((-p).alias("negated"), at.alias("candidate_id")),
        )
    )
    best = F.slice(ordered, 1, k)
    rows = df.select(key, F.posexplode_outer(best).alias("at", "entry"))
    return rows.where("at IS NOT NULL").select(
        key,
        (F.col("at") + 1).alias("rank"),
        F.col("entry.candidate_id"),
        (-F.col("entry.negated")).alias("probability"),
    )


def target_nll(df, target="target_id", probabilities="probabilities"):
    """Add the target's probability and its negative log likelihood."""
    return df.withColumn(
        "target_probability", F.get(F.col(probabilities), F.col(target))
    ).withColumn("target_nll", -F.ln("target_probability"))


def softmax_long(
    df,
    group="group_id",
    candidate="candidate_id",
    logit="logit",
    slice_size=SLICE_CANDIDATES,
):
    """Add ``probability`` to rows ``(group, candidate, logit)``.

    Each slice of a group's candidate ids is shifted and summed by itself. The
    few slice totals of a group give the factor that turns a slice's weights into
    probabilities of the whole group. A masked candidate (minus infinity) has
    probability 0, also where all of its slice is masked.
    """
    masked = F.lit(float("-inf"))
    part = Window.partitionBy(group, "_slice")
    weighted = (
        df.withColumn("_slice", F.floor(F.col(candidate) / slice_size))
        .withColumn("_top", F.max(logit).over(part))
        .withColumn(
            "_weight",
            F.when(F.col("_top") == masked, 0.0).otherwise(F.exp(F.col(logit) - F.col("_top"))),
        )
        .withColumn("_sum", F.sum("_weight").over(part))
    )
    slices = weighted.groupBy(group, "_slice").agg(
        F.max("_top").alias("_top"), F.max("_sum").alias("_sum")
    )
    groups = slices.groupBy(group).agg(
        F.max("_top").alias("_highest"),
        F.collect_list(F.struct("_slice", "_top", "_sum")).alias("_parts"),
    )

    def shift(one):
        return F.when(one["_top"] == masked, 0.0).otherwise(F.exp(one["_top"] - F.col("_highest")))

    total = F.aggregate(
        "_parts", F.lit(0.0), lambda acc, one: acc + one["_sum"] * shift(one)
    )
    factors = groups.withColumn("_total", total).select(
        F.col(group),
        F.inline(
            F.transform(
                "_parts",
                lambda one: F.struct(
                    one["_slice"].alias("_slice"),
                    F.try_divide(shift(one), F.col("_total")).alias("_factor"),
                ),
            )
        ),
    )
    return (
        weighted.join(factors, [group, "_slice"])
        .withColumn("probability", F.col("_weight") * F.col("_factor"))
        .drop("_slice", "_top", "_weight", "_sum", "_factor")
    )


def top_k_long(df, k=C.TOP_K, group="group_id", candidate="candidate_id"):
    """The ``k`` most probable rows of each group with their ``rank``.

    Spark keeps ``k`` rows per group in each task before it shuffles.
    """
    order = Window.partitionBy(group).orderBy(F.desc("probability"), F.asc(candidate))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def probability_shift(base, tuned, key):
    """Target probability and loss of two models side by side, and the change."""
    columns = ["target_probability", "target_nll"]

    def named(df, prefix):
        return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])

    return (
        named(base, "base")
        .join(named(tuned, "tuned"), key)
        .withColumn(
            "probability_change",
            F.col("tuned_target_probability") - F.col("base_target_probability"),
        )
        .withColumn("nll_change", F.col("tuned_target_nll") - F.col("base_target_nll"))
    )
