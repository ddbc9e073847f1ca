"""Similarity of embeddings."""

from pyspark.sql import functions as F

from gradeloom.functions.vectors import cosine
from gradeloom.operators.inference import embed_together
from gradeloom.operators.ordering import number_rows
from gradeloom.sources.staging import stage

FIELDS = ["root_cause", "recommendation"]


def add_cosine(df, left, right, name="similarity"):
    return df.withColumn(name, cosine(F.col(left), F.col(right)))


def rank_candidates(pairs, reference="reference_id", candidate="candidate_id"):
    """Add ``rank``: the candidates of each reference, the most similar first."""
    order = [F.desc("similarity"), F.asc(candidate)]
    return number_rows(pairs, order, name="rank", within=[reference])


def field_similarity(df, valid="is_valid"):
    """Similarity of both predicted fields to the expected ones, on valid rows."""

    def of(field):
        return F.when(
            F.col(valid), cosine(F.col(f"predicted_{field}"), F.col(f"expected_{field}"))
        )

    return df.withColumns(
        {
            "root_cause_similarity": of("root_cause_embedding"),
            "recommendation_similarity": of("recommendation_embedding"),
        }
    )


def _pair_key(predicted, expected):
    """128 bits that stand for a pair of texts; null when either is."""
    size = F.octet_length(predicted).cast("string")
    return F.unhex(F.md5(F.concat(size, F.lit(":"), predicted, expected)))


def pair_table(pairs, factory, name="text-pairs"):
    """``(key, similarity)`` of ``(key, predicted, expected)`` rows, written out.

    Each distinct pair is embedded and compared once; a text that several pairs of a
    batch share goes to the model once for them. Texts and vectors end here.
    """
    distinct = pairs.groupBy("key").agg(
        F.any_value("predicted").alias("predicted"), F.any_value("expected").alias("expected")
    )
    vectors = embed_together(distinct, ["predicted", "expected"], factory)
    compared = add_cosine(vectors, "predicted_vector", "expected_vector")
    return stage(compared.select("key", "similarity"), name)


def text_similarity(df, factory, valid="is_valid", fields=FIELDS):
    """Similarity of each predicted field's text to the expected one, on valid rows.

    ``factory`` gives an embedding model. The rows are written out with a key for each
    pair of texts, so that what gave the texts is worked out once; only keys and cosines
    are joined. A null text has no similarity.
    """
    keys = {
        f"_{field}_key": F.when(F.col(valid), _pair_key(F.col(field), F.col(f"expected_{field}")))
        for field in fields
    }
    rows = stage(df.withColumns(keys), "compared-rows")
    pairs = [
        F.struct(
            F.col(f"_{field}_key").alias("key"),
            F.col(field).alias("predicted"),
            F.col(f"expected_{field}").alias("expected"),
        )
        for field in fields
    ]
    pairs = rows.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")
    known = pair_table(pairs.where("key IS NOT NULL"), factory)
    for field in fields:
        own = known.toDF(f"_{field}_key", f"{field}_similarity")
        rows = rows.join(own, f"_{field}_key", "left")
    return rows.drop(*keys)
