"""JSON arrays read by many tasks.

An array in one file has no line that a reader could split at. It is read in byte ranges
as the pieces between closing braces, which Spark's text reader can split, and the borders
of the elements are found by two states: whether a place is inside a string, and how deep
it is nested. A range tells how it changes these for either start; the states at the
starts of all ranges follow from the row of ranges, and then every range cuts its own
elements. Only an element that lies across a border is put together from its pieces.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from gradeloom.sources.staging import stage

_QUOTE, _ESCAPE, _COMMA = b'"'[0], b"\\"[0], b","[0]
_OPEN, _CLOSE = np.zeros(256, np.int8), np.zeros(256, np.int8)
_OPEN[[*b"[{"]], _CLOSE[[*b"]}"]] = 1, 1
_RANGE = "file string, start long, inside_0 boolean, inside_1 boolean, depth_0 long, depth_1 long"
_PIECE = "file string, start long, piece long, last boolean, text string"


def _ranges(batches):
    """(file, start, bytes) of each run of rows of one range, the braces put back.

    The reader gives what is between braces; the last of a file is followed by none.
    """
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        values = batch.column("value").to_pylist()
        begin = 0
        for end in range(1, len(files) + 1):
            if end == len(files) or (files[end], starts[end]) != (files[begin], starts[begin]):
                text = "}".join(values[begin:end]) + "}"
                yield files[begin], starts[begin], text.encode("utf-8", "surrogatepass")
                begin = end


def _quotes(data):
    """Mask of the quotes that no backslash escapes."""
    found = data == _QUOTE
    for place in np.flatnonzero(found[1:] & (data[:-1] == _ESCAPE)) + 1:
        before = place - 1
        while before >= 0 and data[before] == _ESCAPE:
            before -= 1
        found[place] = (place - before) % 2 == 1
    return found


def _states(data, inside):
    """(mask of bytes outside strings, depth after each byte from 0, inside at the end)."""
    quotes = _quotes(data)
    count = np.cumsum(quotes) + int(inside)
    outside = (count % 2 == 0) & ~quotes
    steps = (_OPEN[data] - _CLOSE[data]) * outside
    return outside, np.cumsum(steps, dtype=np.int64), bool(count[-1] % 2) if len(data) else inside


def _summaries(batches):
    """How each range changes the states, for a start outside and inside a string.

    A range begins after a brace, so no backslash stands right before it.
    """
    key, found = None, None

    def row():
        (file, start), ((a, x), (b, y)) = key, found
        return (file, start, a, b, x, y)

    out = []
    for file, start, text in _ranges(batches):
        if key != (file, start):
            if key is not None:
                out.append(row())
            key, found = (file, start), [(False, 0), (True, 0)]
        data = np.frombuffer(text, np.uint8)
        for which, (inside, depth) in enumerate(found):
            _, depths, inside = _states(data, inside)
            found[which] = (inside, depth + int(depths[-1]))
    if key is not None:
        out.append(row())
    names = [field.split()[0] for field in _RANGE.split(", ")]
    columns = list(zip(*out)) if out else [()] * len(names)
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _cutter(begin):
    """Cuts the ranges at the commas of the array; ``begin`` has their states."""

    def run(batches):
        key, state, piece, held = None, None, 0, []
        for file, start, text in _ranges(batches):
            out = []
            if key != (file, start):
                if key is not None:
                    out.append((*key, piece, True, b"".join(held)))
                key, state, piece, held = (file, start), begin[file, start], 0, []
            data = np.frombuffer(text, np.uint8)
            inside, depth = state
            outside, depths, ends_inside = _states(data, inside)
            depths = depths + depth
            commas = np.flatnonzero(outside & (data == _COMMA) & (depths == 1)).tolist()
            # The brackets of the array itself belong to no element.
            frame = (_OPEN[data] == 1) & outside & (depths == 1)
            frame |= (_CLOSE[data] == 1) & outside & (depths == 0)
            if frame.any():
                data = data.copy()
                data[frame] = b" "[0]
                text = data.tobytes()
            for a, b in zip([0, *[c + 1 for c in commas]], commas):
                out.append((*key, piece, False, b"".join([*held, text[a:b]])))
                held, piece = [], piece + 1
            held.append(text[commas[-1] + 1 :] if commas else text)
            state = ends_inside, int(depths[-1])
            yield _pieces(out)
        if key is not None:
            yield _pieces([(*key, piece, True, b"".join(held))])

    return run


def _pieces(rows):
    names = [field.split()[0] for field in _PIECE.split(", ")]
    columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in names]
    columns[-1] = [text.decode("utf-8", "surrogatepass") for text in columns[-1]]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _starts(summaries):
    """{(file, start): (inside a string, depth)} from one row per range, as many as the
    reader has planned."""
    begin, now = {}, {}
    for row in sorted(summaries.collect(), key=lambda r: (r.file, r.start)):
        inside, depth = begin[row.file, row.start] = now.get(row.file, (False, 0))
        after = row.inside_1 if inside else row.inside_0
        now[row.file] = after, depth + (row.depth_1 if inside else row.depth_0)
    return begin


def read_array_elements(spark, path):
    """``(file, place, element)``: the text of each element of the JSON arrays at ``path``
    and its 0-based place in its file.

    A file holds one array. Ranges are as long as the session lets scans be
    (``spark.sql.files.maxPartitionBytes``), and the file is read twice. A text that is no
    array gives elements that do not parse.
    """
    rows = spark.read.option("lineSep", "}").text(path)
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    begin = _starts(rows.mapInArrow(_summaries, _RANGE))
    pieces = stage(rows.mapInArrow(_cutter(begin), _PIECE), "array-pieces")
    # One row per range: how many commas stand before it.
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.where("last").select(
        "file", "start", F.coalesce(F.sum("piece").over(earlier), F.lit(0)).alias("before")
    )
    placed = pieces.join(F.broadcast(before), ["file", "start"])
    placed = placed.withColumn("place", F.col("before") + F.col("piece"))
    own = placed.where("piece > 0 AND NOT last").select("file", "place", F.col("text").alias("element"))
    # What lies at a border: a first and a last piece per range.
    ends = placed.where("piece = 0 OR last").groupBy("file", "place").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text")
    )
    # The brace put back after the last piece of a file, which has none.
    final = Window.partitionBy("file")
    ends = ends.withColumn("_final", F.max("place").over(final) == F.col("place"))
    text = F.when(F.col("_final"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    ends = ends.select("file", "place", text.alias("element"))
    # An array without elements is one blank piece.
    ends = ends.where("place > 0 OR trim(BOTH ' \t\n\r' FROM element) != ''")
    return own.unionByName(ends)
