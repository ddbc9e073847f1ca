"""Best-two-fit packing of documents into sequences of a fixed token count.

A sequence takes the longest piece left and is filled greedily with the longest piece
that still fits. Then its smallest piece gives way to two unpacked pieces whenever two
of them fill the widened gap more tightly.

Pieces of one length are interchangeable, so the method runs on the histogram of
lengths, which has at most ``capacity`` rows however many documents there are. It
yields layouts (the lengths in one sequence) and how often each is used. Each piece
then finds its place by its rank among the pieces of its length, in one narrow stage.
"""

import os
import re
import struct
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.operators.ordering import number_rows
from gradeloom.sources.staging import stage

CAPACITY = 1024
END_ID = 2
CACHED_PARTS = 1_000_000
CACHED_WORD_CHARS = 48
#: Words of these characters fall into parts as in the library by the expression below.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t\n\r -~{_LATIN}]*")
_PART = re.compile(
    rf" ?[{_LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+"
)
_PART_START = re.compile(r" (?=\S)")
#: Characters of texts that are cut and encoded together.
SEGMENT = 1 << 19
_ENCODERS = {}


class CachedEncoder:
    """Ids of whole texts by the tokenizers library, as little-endian bytes.

    Pieces of plain characters are cut into the parts that the byte-level splitter makes.
    It always starts a part at a space that stands before another character than white
    space; other pieces are cut there only. Each distinct part is encoded once per worker,
    new parts of several texts together. A text that holds a special token goes to the
    library whole, since special tokens are taken out before the splitting.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        self._library = Tokenizer.from_file(path)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._cache = {}

    def encode(self, text):
        return self.encode_many([text])[0]

    def encode_many(self, texts):
        """The ids of each text; the texts should be some hundred thousand characters."""
        cuts = [self._parts(text) for text in texts]
        found = [[*map(self._cache.get, parts)] for parts in cuts]
        lacking = [_places_of_none(ids) for ids in found]
        new = {parts[i] for parts, places in zip(cuts, lacking) for i in places}
        made = self._learned([*new]) if new else {}
        for parts, ids, places in zip(cuts, found, lacking):
            for i in places:
                ids[i] = made[parts[i]]
        return [b"".join(ids) for ids in found]

    def _parts(self, text):
        if any(s in text for s in self._special):
            return [text]
        parts = []
        for segment in _segments(text):
            if _PLAIN.fullmatch(segment):
                parts += _PART.findall(segment)
            else:
                first, *words = _join_padding(segment.split(" "))
                parts += [first, *(" " + word for word in words)]
        return parts

    def _learned(self, parts):
        found = self._library.encode_batch_fast(parts, add_special_tokens=False)
        made = {part: struct.pack(f"<{len(ids)}I", *ids) for part, ids in zip(parts, (one.ids for one in found))}
        if len(self._cache) >= CACHED_PARTS:
            self._cache.clear()
        self._cache.update((part, ids) for part, ids in made.items() if len(part) <= CACHED_WORD_CHARS)
        return made


def _places_of_none(values):
    places, at = [], -1
    for _ in range(values.count(None)):
        at = values.index(None, at + 1)
        places.append(at)
    return places


def _segments(text):
    """Pieces of a text, cut where a part starts."""
    start = 0
    while len(text) - start > SEGMENT:
        found = _PART_START.search(text, start + SEGMENT)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def _join_padding(words):
    """Parts of a split at spaces, joined again where a cut would not be safe."""
    joined = [words[0]]
    for word in words[1:]:
        if not word or word[0].isspace():
            joined[-1] += " " + word
        else:
            joined.append(word)
    return joined


def _encoder(path):
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


def _encoded(encoder, column):
    """Ids of the texts of a column, encoded some at a time."""
    held, size = [], 0
    for value in column:
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= SEGMENT:
            yield from encoder.encode_many(held)
            held, size = [], 0
    yield from encoder.encode_many(held)


def cut(n, capacity):
    """(start, length) of each piece: full ones, a shorter one first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(df, path, capacity=CAPACITY, end_id=END_ID, key="doc_id", text="text"):
    """One row per piece: key, piece, start, length and crc32 of the ids."""
    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    )
    end = struct.pack("<I", end_id)

    def cut_batches(batches):
        encoder = _encoder(path)
        for batch in batches:
            rows, keys = [], iter(batch.column(0).to_pylist())
            for ids in _encoded(encoder, batch.column(1)):
                key_value, ids = next(keys), ids + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((key_value, i, start, length, crc))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [batch.schema.field(0).type, *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], schema.names
            )

    pairs = df.select(key, text)
    return pairs.mapInArrow(cut_batches, schema)


def _pair(lengths, left, used, gap, floor):
    """The two unpacked lengths with the largest sum in (floor, gap], or None."""
    best, found = floor, None
    for i in range(bisect_right(lengths, gap) - 1, -1, -1):
        a = lengths[i]
        if 2 * a <= best:
            break
        free_a = left[a] - used.get(a, 0)
        if free_a <= 0:
            continue
        j = min(i, bisect_right(lengths, gap - a) - 1)
        while j >= 0 and a + lengths[j] > best:
            b = lengths[j]
            if left[b] - used.get(b, 0) - (a == b) > 0:
                best, found = a + b, (a, b)
                break
            j -= 1
        if best == gap:
            break
    return found


def _layout(lengths, left, capacity):
    """Lengths of one sequence, longest first, from what is left."""
    longest = lengths[-1]
    layout, used, gap = [longest], {longest: 1}, capacity - longest
    i = bisect_right(lengths, gap) - 1
    while gap and i >= 0:
        size = lengths[i]
        if size > gap or left[size] - used.get(size, 0) <= 0:
            i -= 1
            continue
        layout.append(size)
        used[size] = used.get(size, 0) + 1
        gap -= size
    while gap and len(layout) > 1:
        smallest = layout[-1]
        used[smallest] -= 1
        pair = _pair(lengths, left, used, gap + smallest, smallest)
        if pair is None:
            used[smallest] += 1
            break
        layout.pop()
        for size in pair:
            used[size] = used.get(size, 0) + 1
        layout = sorted([*layout, *pair], reverse=True)
        gap += smallest - sum(pair)
    return layout, used


def plan_layouts(histogram, capacity):
    """[(layout, times)] that use up ``{length: count}``.

    A layout is repeated while every length it takes lasts, so there are about as
    many layouts as lengths, not as sequences.
    """
    left = {size: count for size, count in histogram.items() if count > 0}
    if any(not 0 < size <= capacity for size in left):
        raise ValueError("a length is not between 1 and the capacity")
    layouts, lengths = [], sorted(left)
    while lengths:
        layout, used = _layout(lengths, left, capacity)
        times = min(left[size] // n for size, n in used.items() if n)
        layouts.append((layout, times))
        for size, n in used.items():
            left[size] -= n * times
        lengths = [size for size in lengths if left[size]]
    return layouts


def _places(layouts):
    """For each length: first ranks, and sequence and offset at each first rank."""
    taken, places, sequence = {}, {}, 0
    for layout, times in layouts:
        offset = 0
        for size in layout:
            rank = taken.get(size, 0)
            places.setdefault(size, []).append((rank, sequence, offset))
            taken[size] = rank + times
            offset += size
        sequence += times
    return {size: np.array(rows, np.int64) for size, rows in places.items()}


def pack(pieces, capacity=CAPACITY, order=("doc_id", "piece"), slices=None):
    """Add ``sequence_id`` and ``offset`` to rows with a ``length``.

    ``order`` names columns that tell the rows apart; rows that are alike in them are
    packed all the same, each once. ``pieces`` is read twice and should be stored. An
    empty table gives an empty one; a length outside 1..capacity (or null) is an error.
    """
    counted = pieces.groupBy("length").count().limit(capacity + 1).collect()
    if any(r.length is None for r in counted):
        raise ValueError("a length is null")
    places = _places(plan_layouts({r.length: r["count"] for r in counted}, capacity))
    pieces = pieces.drop("sequence_id", "offset")
    ranked = number_rows(
        pieces, [F.col(c) for c in order], "_rank", within=["length"], slices=slices
    )
    names = pieces.columns
    schema = T.StructType([*pieces.schema.fields])
    schema = schema.add("sequence_id", "long").add("offset", "long")

    def place_batches(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False) - 1
            sequence, offset = np.zeros((2, len(length)), np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                first, base, place = places[int(size)].T
                at = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows] = base[at] + rank[rows] - first[at]
                offset[rows] = place[at]
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], schema.names
            )

    return ranked.mapInArrow(place_batches, schema)


def pack_documents(df, path, capacity=CAPACITY, end_id=END_ID, key="doc_id", text="text"):
    """Pieces of all documents with their sequences and places in them.

    A null or empty text is one piece that holds only the end id. A null key or
    repeated keys are kept as they are: every row of ``df`` is packed.
    """
    pieces = stage(token_pieces(df, path, capacity, end_id, key, text), "pieces")
    return pack(pieces, capacity, (key, "piece"))


@query("op9_best_two_fit")
def op9_best_two_fit(spark, sf_dir):
    import public_tokenizers

    documents = read(spark, sf_dir, "documents")
    return pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))
