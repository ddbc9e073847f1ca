"""Descriptions of a data set."""

from pyspark.sql import functions as F

from gradeloom.functions.text import words
from gradeloom.functions.tokens import ignored_count, tokenize
from gradeloom.operators.ordering import number_rows


def dataset_summary(df, key="example_id"):
    """One row: number of rows, column names and the first row as JSON."""
    return df.agg(
        F.count("*").alias("num_rows"),
        F.lit(", ".join(df.columns)).alias("column_names"),
        F.to_json(F.min_by(F.struct(*df.columns), key)).alias("first_row"),
    )


def category_listing(df, order="example_id"):
    """Categories numbered from 1 in the order of a unique column, gaps or not."""
    numbered = number_rows(df.select(order, "category"), [F.asc(order)], "number")
    return numbered.select(F.col("number").cast("long").alias("number"), "category")


def category_distribution(df):
    return df.groupBy("category").agg(F.count("*").alias("examples"))


def token_word_ratio(df, text="text"):
    """Add word count, token count and tokens per word (null without words)."""
    return (
        df.withColumn("word_count", F.size(words(F.col(text))))
        .withColumn("token_count", F.size(tokenize(F.col(text))))
        .withColumn("token_word_ratio", F.try_divide("token_count", "word_count"))
    )


def sequence_lengths(df, ids="ids", labels="labels"):
    """Add token, ignored and supervised counts of each sequence.

    A sequence without an answer has null labels: all of it is ignored.
    """
    ignored = F.coalesce(
        F.when(F.col(labels).isNotNull(), ignored_count(F.col(labels))), F.size(ids)
    )
    return (
        df.withColumn("token_count", F.size(ids))
        .withColumn("has_answer", F.col(labels).isNotNull())
        .withColumn("ignored_count", ignored)
        .withColumn("supervised_count", F.col("token_count") - F.col("ignored_count"))
    )


#: Size of a length sketch. Up to as many sequences are held exactly; beyond, a percentile
#: is off by some thousandth of the ranks.
SKETCH_SIZE = 4096
PERCENTILES = (50, 95, 99)


def length_sketches(lengths, parts=(), size=SKETCH_SIZE):
    """One row per part (of all rows, without any) with counts, totals and a mergeable
    quantile sketch of the token counts. Small enough to be stored beside the data."""
    return lengths.groupBy(*parts).agg(
        F.count("*").alias("sequences"),
        F.count_if(~F.col("has_answer")).alias("without_answer"),
        F.min("token_count").alias("min_tokens"),
        F.sum("token_count").alias("tokens"),
        F.max("token_count").alias("max_tokens"),
        F.sum("ignored_count").alias("ignored_tokens"),
        F.sum("supervised_count").alias("supervised_tokens"),
        F.kll_sketch_agg_bigint(F.col("token_count").cast("long"), size).alias("sketch"),
    )


def merge_length_sketches(sketches, parts=(), size=SKETCH_SIZE):
    """The sketches of parts as those of larger parts, without reading a sequence again."""
    sums = ["sequences", "without_answer", "tokens", "ignored_tokens", "supervised_tokens"]
    return sketches.groupBy(*parts).agg(
        *[F.sum(n).alias(n) for n in sums],
        F.min("min_tokens").alias("min_tokens"),
        F.max("max_tokens").alias("max_tokens"),
        F.kll_merge_agg_bigint("sketch", size).alias("sketch"),
    )


def length_stats(sketches, percentiles=PERCENTILES):
    """Lengths, totals and percentiles of each row of sketches; percentiles are lengths
    that occur, and null without any."""
    at = F.kll_sketch_get_quantile_bigint
    some = F.col("max_tokens").isNotNull()
    found = {f"p{p}_tokens": F.when(some, at("sketch", F.lit(p / 100))) for p in percentiles}
    mean = F.try_divide("tokens", "sequences")
    return sketches.withColumns({"avg_tokens": mean, **found}).drop("sketch", "tokens")


def sequence_length_stats(lengths):
    """One row over all sequences: lengths, percentiles, totals, how many lack an answer."""
    return length_stats(length_sketches(lengths))
