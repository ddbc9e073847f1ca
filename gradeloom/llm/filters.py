"""Membership filters of fixed size, to leave rows without a partner where they are."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

SPLIT_BITS = 1 << 22


def filter_of(rows, column, bits):
    """Bit array that holds every value of a long column. ``bits`` is a power of two.

    At most ``bits / 32`` numbers go to the driver. A full filter lets everything pass,
    so results never depend on it.
    """
    bit = F.pmod(F.col(column), F.lit(bits))
    masks = rows.select(
        F.floor(bit / 32).alias("word"),
        F.expr(f"shiftleft(1L, cast(pmod({column}, 32) as int))").alias("mask"),
    )
    masks = masks.groupBy("word").agg(F.bit_or("mask").cast("long").alias("mask"))
    found = np.zeros(bits // 32, np.uint32)
    for batch in masks.toArrow().to_batches():
        words = batch.column(0).to_numpy(zero_copy_only=False)
        found[words] = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint32)
    return found


def held(found, values, bits):
    """Mask of the unsigned values that the filter may hold."""
    place = values % np.uint64(bits)
    return (found[place // np.uint64(32)] >> (place % np.uint64(32)).astype(np.uint32)) & np.uint32(1) == 1


def may_hold(spark, found, value, bits):
    """Column that is true where the filter may hold a long value, null for a null one.

    The filter is one array that travels with the job and is asked by expressions, so no
    row leaves the JVM for it.
    """
    words = pa.table({"words": pa.array([found.view(np.int32)], pa.list_(pa.int32()))})
    place = F.pmod(value, F.lit(bits))
    word = F.get(spark.createDataFrame(words).scalar(), F.floor(place / 32).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1), (place % 32).cast("int"))
    return word.bitwiseAND(bit) != 0


def split(df, rows, key, bits=SPLIT_BITS):
    """(rows of ``df`` whose key is not in ``rows``, the rest) by a filter.

    The rest may hold some rows that have no partner either. Null keys are in the rest.
    """
    found = filter_of(rows.select(F.xxhash64(key).alias("_name")), "_name", bits)
    may = F.col(key).isNull() | may_hold(df.sparkSession, found, F.xxhash64(key), bits)
    return df.where(~may), df.where(may)
