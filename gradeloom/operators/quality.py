"""Validation of training examples and of extracted answers."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions.extract import is_valid_structure


def _listed(heading, missing):
    return F.concat(F.lit(heading), F.array_join(missing, ", "))


def _missing(conditions):
    """Names whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions]))


def add_errors(examples):
    """Add ``errors``, an array that is empty for a good row; null is missing.

    The first kind of error found in a row ends the check of that row, so a row
    has one error at most, which lists every field it concerns.
    """
    output = F.col("output_raw")
    kind = F.schema_of_variant(output)
    missing_top = _missing(
        [
            ("instruction", F.col("instruction").isNull()),
            ("input", F.col("input").isNull()),
            ("output", F.coalesce(kind, F.lit("VOID")) == "VOID"),
        ]
    )

    def absent(name):
        field = F.schema_of_variant(F.try_variant_get(output, f"$.{name}", "variant"))
        return F.coalesce(field, F.lit("VOID")) == "VOID"

    missing_output = _missing([(n, absent(n)) for n in C.REQUIRED_OUTPUT_FIELDS])
    error = (
        F.when(F.size(missing_top) > 0, _listed("missing fields: ", missing_top))
        .when(~kind.startswith("OBJECT"), F.lit("output has to be an object"))
        .when(
            F.size(missing_output) > 0,
            _listed("missing output fields: ", missing_output),
        )
    )
    return examples.withColumn("errors", F.array_compact(F.array(error)))


def validate_examples(examples):
    """``(example_id, errors)`` of every row."""
    return add_errors(examples).select("example_id", "errors")


def validation_report(validated):
    """Number of examples per error; an empty report means the data passed."""
    return (
        validated.select(F.explode_outer("errors").alias("error"))
        .where("error IS NOT NULL")
        .groupBy("error")
        .agg(F.count("*").alias("examples"))
    )


def add_structure_validity(df):
    """Add ``is_valid`` for the extracted category, root cause and recommendation."""
    valid = is_valid_structure(
        F.col("category"), F.col("root_cause"), F.col("recommendation")
    )
    return df.withColumn("is_valid", valid)
