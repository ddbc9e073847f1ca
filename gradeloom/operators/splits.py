"""Train / validation splits that give the same result on every run."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.operators.ordering import number_rows


def _label(in_validation):
    return F.when(in_validation, F.lit("validation")).otherwise(F.lit("train"))


def split_by_position(df, order="example_id", held_out=None):
    """Add ``split``: the rows at the given 0-based places in the order of a unique
    column are held out, whatever its values."""
    held_out = C.VALIDATION_POSITIONS if held_out is None else held_out
    placed = number_rows(df, [F.asc(order)], "_place")
    held = F.col("_place").isin([p + 1 for p in held_out])
    return placed.withColumn("split", _label(held)).drop("_place")


def split_by_hash(df, key="example_id", share=0.2):
    """Add ``split``: about ``share`` of the keys are held out, by their hash."""
    if not 0 <= share < 1:
        raise ValueError("share must be at least 0 and below 1")
    bound = f"{int(share * 16**8):08x}"
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return df.withColumn("split", _label(digits < F.lit(bound)))
