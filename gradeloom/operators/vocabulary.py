"""Token ids: building a vocabulary, encoding and decoding.

Rows are written out in slices. A slice names each of its distinct items (tokens or ids)
once, in a dictionary of its own, and its rows hold places in that dictionary. Only the
dictionaries are counted, joined with the vocabulary and gathered again, so an item costs
a joined row per slice, however often it occurs there, and no row of the table is moved
for it. A slice is bounded by its number of items, so its dictionary is too.

Ids rank the tokens by falling count. The most frequent ones, which stand in every
slice, are looked up in a bounded broadcast table and never shuffled.
"""

from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from gradeloom import constants as C
from gradeloom.operators.ordering import number_rows
from gradeloom.sources.staging import stage

LOOKUP_TOKENS = 30_000
LOOKUP_BYTES = 2 * 1024 * 1024
SLICE_ITEMS = 1 << 17
NO_PLACE = -1
UNKNOWN_ID = -1
UNKNOWN_TOKEN = "�"


class Sliced(NamedTuple):
    """Rows with places in their slice's dictionary (``table``), and one row per slice and
    distinct item: ``(_slice, _place, item)`` with the item's count ``n`` (``entries``)."""

    table: DataFrame
    entries: DataFrame
    items: str


def _entries(table):
    each = F.posexplode(F.arrays_zip(F.col("_items").alias("item"), F.col("_counts").alias("n")))
    own = table.where("_items IS NOT NULL").select("_slice", each.alias("_place", "_entry"))
    return own.select("_slice", "_place", "_entry.*")


def _cut(lengths, limit):
    """Borders of runs of rows with at most ``limit`` items, or of one row."""
    borders, held = [0], 0
    for place, length in enumerate(lengths):
        if held and held + length > limit:
            borders.append(place)
            held = 0
        held += length
    return [*borders, len(lengths)]


def slice_items(df, items="tokens", keep=True, slice_items=SLICE_ITEMS):
    """``df`` written out in slices; without ``keep`` its array column is left out.

    The first row of a slice carries its dictionary: distinct items and their counts.
    """
    item_type = df.schema[items].dataType.elementType
    names = [c for c in df.columns if keep or c != items]
    schema = T.StructType([df.schema[c] for c in names]).add("_slice", "long")
    schema = schema.add("_places", "binary").add("_items", T.ArrayType(item_type)).add("_counts", T.ArrayType(T.LongType()))

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 40)
        for batch in batches:
            arrays = batch.column(batch.schema.get_field_index(items))
            lengths = arrays.value_lengths().fill_null(0).to_pylist()
            borders = _cut(lengths, slice_items)
            for start, stop in zip(borders, borders[1:]):
                if stop > start:
                    yield _coded(batch.slice(start, stop - start), items, names, next(numbers), schema.names)

    table = stage(df.mapInArrow(run, schema), "sliced")
    return Sliced(table.drop("_items", "_counts"), _entries(table), items)


def _coded(batch, items, names, number, columns):
    """A slice with its dictionary in the first row."""
    arrays = batch.column(batch.schema.get_field_index(items))
    coded = arrays.flatten().dictionary_encode()
    lengths = arrays.value_lengths()
    places = coded.indices.fill_null(NO_PLACE).to_numpy().astype("<i4")
    counts = np.bincount(places[places >= 0], minlength=len(coded.dictionary))
    ends = lengths.fill_null(0).to_numpy().cumsum()
    held = [
        None if length is None else places[end - length : end].tobytes()
        for length, end in zip(lengths.to_pylist(), ends)
    ]
    first = pa.array([0, *[len(counts)] * batch.num_rows], pa.int32())
    others = pa.array([not len(counts), *[True] * (batch.num_rows - 1)])
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(batch.schema.get_field_index(n)) for n in names),
            pa.array([number] * batch.num_rows, pa.int64()),
            pa.array(held, pa.binary()),
            pa.ListArray.from_arrays(first, coded.dictionary, mask=others),
            pa.ListArray.from_arrays(first, pa.array(counts, pa.int64()), mask=others),
        ],
        names=columns,
    )


def build_vocabulary(rows, tokens="tokens"):
    """``(token, id, count)`` of the tokens of an array column or of sliced rows, ids from 0."""
    if isinstance(rows, Sliced):
        counted = rows.entries.select(F.col("item").alias("token"), "n")
    else:
        # The plain explode would add a filter for empty arrays, push it below and
        # there tokenize every text a second time.
        counted = rows.select(F.explode_outer(tokens).alias("token"), F.lit(1).alias("n"))
    counts = counted.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("count"))
    ranked = number_rows(counts, [F.desc("count"), F.asc("token")], name="_rank")
    return ranked.select("token", (F.col("_rank") - 1).cast("long").alias("id"), "count")


def lookup_size(vocabulary, max_tokens=LOOKUP_TOKENS, max_bytes=LOOKUP_BYTES):
    """How many of the lowest ids the bounded lookup holds."""
    sizes = [max_tokens >> shift for shift in range(0, 20, 4) if max_tokens >> shift]
    held = [
        F.sum(F.when(F.col("id") < size, F.octet_length("token"))).alias(f"bytes_{size}")
        for size in sizes
    ]
    row = vocabulary.agg(F.count("*").alias("total"), *held).first()
    for size in sizes:
        if (row[f"bytes_{size}"] or 0) <= max_bytes:
            return min(size, row["total"])
    return 0


def _recoded(sliced, vocabulary, on, value, missing, max_tokens):
    """The slices with every dictionary entry replaced; their rows stay as they are.

    Frequent items come from a broadcast side of bounded size, the others by a join in
    which no key is hot: a slice holds an item once, and these stand in few slices.
    """
    size = lookup_size(vocabulary, max_tokens)
    vocabulary = vocabulary.withColumn("id", F.col("id").cast("long"))
    pairs = vocabulary.select(F.col(on).alias("item"), F.col(value).alias("_value"), F.col("id").alias("_id"))
    frequent = F.broadcast(pairs.where(F.col("_id") < size).drop("_id"))
    found = sliced.entries.join(frequent, "item")
    rest = sliced.entries.join(frequent, "item", "left_anti")
    rest = rest.join(pairs.where(F.col("_id") >= size).drop("_id"), "item", "left")
    own = F.coalesce("_value", F.lit(missing)).alias("item")
    entries = found.unionByName(rest).select("_slice", "_place", own, "n")
    return sliced._replace(entries=stage(entries, "slice-entries"))


def _with_items(sliced, name, missing, made, result_type):
    """The rows with what ``made`` gives for the array of their items.

    The values of a slice come right before its rows in a stream sorted by slice, so a
    worker holds one slice's values at a time and rows carry their places only.
    """
    listed = F.sort_array(F.collect_list(F.struct("_place", "item")))["item"]
    values = sliced.entries.groupBy("_slice").agg(listed.alias("_values"))
    kept = [c for c in sliced.table.columns if c not in (name, "_slice", "_places")]
    rows = sliced.table.select("_slice", "_places", *kept)
    both = rows.unionByName(stage(values, "slice-values"), allowMissingColumns=True)
    both = both.repartition("_slice").sortWithinPartitions("_slice", F.asc_nulls_last("_values"))
    schema = T.StructType([rows.schema[c] for c in kept]).add(name, result_type)
    return both.mapInArrow(_read_items(kept, missing, made, schema), schema)


def _read_items(kept, missing, made, schema):
    def run(batches):
        current, values = None, None
        for batch in batches:
            slices = batch.column("_slice").to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(slices)) + 1), len(slices)]
            for start, stop in zip(borders, borders[1:]):
                part = batch.slice(start, stop - start)
                if slices[start] != current:
                    current, own = slices[start], part.column("_values")[0]
                    values = own.values.fill_null(missing) if own.is_valid else None
                    part = part.slice(int(own.is_valid))
                if part.num_rows:
                    arrays = _item_arrays(part.column("_places"), values, missing)
                    columns = [part.column(c) for c in kept]
                    yield pa.RecordBatch.from_arrays([*columns, made(arrays)], schema.names)

    return run


def _item_arrays(places, values, missing):
    """Lists of items from rows of places; rows of a slice without values are empty."""
    codes = np.frombuffer(b"".join(p for p in places.to_pylist() if p), "<i4")
    lengths = pc.fill_null(pc.binary_length(places), 0).to_numpy() // 4
    offsets = pa.array([0, *lengths.cumsum()], pa.int32())
    if values is None:
        items = pa.array([], pa.string() if isinstance(missing, str) else pa.int64())
    else:
        items = values.take(pa.array(codes, mask=codes < 0)).fill_null(missing)
    return pa.ListArray.from_arrays(offsets, items, mask=places.is_null())


def encode_slices(sliced, vocabulary, max_tokens=LOOKUP_TOKENS):
    """The same slices with ids in place of tokens; no row is read."""
    return _recoded(sliced, vocabulary, "token", "id", UNKNOWN_ID, max_tokens)


def encode(rows, vocabulary, tokens="tokens", name="ids", max_tokens=LOOKUP_TOKENS):
    """Add the ids of a token array (null for a null one) to a table or sliced rows."""
    sliced = rows if isinstance(rows, Sliced) else slice_items(rows, tokens)
    ids = encode_slices(sliced, vocabulary, max_tokens)
    return _with_items(ids, name, UNKNOWN_ID, lambda arrays: arrays, T.ArrayType(T.LongType()))


def decode(
    rows,
    vocabulary,
    ids="ids",
    name="decoded",
    skip_special_tokens=False,
    max_tokens=LOOKUP_TOKENS,
):
    """Add the text of an id array, or of slices of ids, with or without special tokens."""
    sliced = rows if isinstance(rows, Sliced) else slice_items(rows, ids)
    sliced = _recoded(sliced, vocabulary, "id", "token", UNKNOWN_TOKEN, max_tokens)
    if skip_special_tokens:
        shown = F.when(F.col("item").isin(C.SPECIAL_TOKENS), "").otherwise(F.col("item"))
        sliced = sliced._replace(entries=sliced.entries.withColumn("item", shown))
    return _with_items(sliced, name, UNKNOWN_TOKEN, lambda arrays: pc.binary_join(arrays, ""), T.StringType())
