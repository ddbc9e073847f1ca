"""Row numbers and running sums that no single task has to hold.

A window over a whole group, or over a whole table, sorts it in one task. These
split the order into slices, number each slice on its own and add what came
before it. The results are the same as the window's.
"""

from functools import reduce

from pyspark.sql import Window, functions as F

from gradeloom.sources.staging import stage


def _keyed(offsets, keys, *values):
    """Offsets under key names of their own, to join them to their source."""
    return offsets.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *values)


def _join_offsets(df, offsets, keys, how):
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    joined = df.join(offsets, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_of_{k}" for k in keys])


def _with_offsets(df, offsets, keys):
    """Add ``_before`` of the row's slice, 0 where the slice comes first."""
    joined = _join_offsets(df, offsets, keys, "left")
    return joined.withColumn("_before", F.coalesce("_before", F.lit(0)))


def number_rows(df, order, name="row_number", within=(), slices=None):
    """Row number by ``order`` inside ``within``, from 1.

    ``order`` must end in a unique column. The table is split by ranges of the
    whole order, so that a hot group spreads over many slices, and is written out
    once, because a second run of the split might cut elsewhere. ``slices`` is the
    number of ranges (default: the session's shuffle partitions); choose it so that
    one range fits in a task.
    """
    within = list(within)
    by = [*[F.col(c) for c in within], *order]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    pinned = stage(ranged.withColumn("_slice", F.spark_partition_id()), "ranged")
    keys = within + ["_slice"]
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A slice border cuts at most one group, so there are fewer rows with
    # something before them than slices: always small enough to broadcast.
    offsets = (
        pinned.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .where("_before > 0")
    )
    offsets = _keyed(offsets, keys, "_before")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = pinned.withColumn("_local", local)
    return (
        _with_offsets(numbered, F.broadcast(offsets), keys)
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_slice", "_local", "_before")
    )


def number_by_hash(df, hash_column, ties, name="row_number", within=(), digits=4):
    """Row number by a hexadecimal hash, then ``ties``, inside ``within``, from 1.

    The first digits of a hash spread the rows evenly and keep their order, so
    they serve as slices without looking at the data. Also adds ``group_rows``.
    """
    within = list(within)
    sliced = df.withColumn("_slice", F.substring(hash_column, 1, digits))
    keys = within + ["_slice"]
    group = Window.partitionBy(*within)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**digits rows per group.
    offsets = (
        sliced.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("group_rows", F.sum("_rows").over(group))
    )
    offsets = _keyed(offsets, keys, "_before", "group_rows")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(hash_column, *ties))
    return (
        _join_offsets(sliced.withColumn("_local", local), offsets, keys, "inner")
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_slice", "_local", "_before")
    )


def running_sum(df, value, order, name, within=(), slice_size=1_000_000):
    """Sum of ``value`` up to each row by the whole-number column ``order``.

    Slices are ranges of ``order``: their sums are taken first, close to the data,
    and each row then adds up only its own slice. Rows with the same ``order``
    in a group share one sum.
    """
    within = list(within)
    sliced = df.withColumn("_slice", F.floor(F.col(order) / F.lit(slice_size)))
    keys = within + ["_slice"]
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.groupBy(*keys)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    offsets = _keyed(offsets, keys, "_before")
    local = F.sum(value).over(Window.partitionBy(*keys).orderBy(order))
    return (
        _with_offsets(sliced.withColumn("_local", local), offsets, keys)
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_slice", "_local", "_before")
    )
