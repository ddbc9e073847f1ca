"""Document fingerprints by SimHash, and search within a Hamming radius.

Runs of one to three words are hashed, and each hash votes with its weight for or against
every bit of the fingerprint. Texts that share most of their runs get fingerprints that
differ in few bits.

For the search a fingerprint is cut into blocks. Two fingerprints within the radius
differ in at most that many blocks, so they agree in some choice of the others; every
choice of blocks is a table, keyed by them, and the tables together hold every pair.
"""

import hashlib
import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

#: Characters of a text that are cut into words at a time.
SEGMENT = 1 << 20
CACHED_WORDS = 200_000
CACHED_WORD_CHARS = 48
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1)
_WORD_HASHES = {}


@dataclass(frozen=True)
class Settings:
    """``bits`` (a multiple of 64) of a fingerprint, ``longest`` run of words as a term.
    A term's weight is its number of words times the length in binary of its count. Texts
    under ``short`` characters also vote with their runs of ``characters`` characters.
    Fingerprints within ``radius`` bits are near."""

    bits: int = 128
    longest: int = 3
    short: int = 120
    characters: int = 4
    radius: int = 6


def _word_hashes(words):
    found = [*map(_WORD_HASHES.get, words)]
    if None in found:
        for i, one in enumerate(found):
            if one is None:
                word = words[i]
                found[i] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
                if len(word) <= CACHED_WORD_CHARS:
                    if len(_WORD_HASHES) >= CACHED_WORDS:
                        _WORD_HASHES.clear()
                    _WORD_HASHES[word] = found[i]
    return np.array(found, np.uint64)


def _segments(text):
    """Words of a text in lists, each from about ``SEGMENT`` characters; cuts fall on
    white space, or inside a word that is longer than that."""
    start = 0
    while len(text) - start > SEGMENT:
        stop = start + SEGMENT
        while stop < len(text) and stop < start + 2 * SEGMENT and not text[stop].isspace():
            stop += 1
        yield text[start:stop].lower().split()
        start = stop
    yield text[start:].lower().split()


def _mixed(x):
    """Every bit of the result depends on every bit of a 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _vote(terms, size, bits):
    """Votes for each byte value at each byte of the fingerprint."""
    terms, counts = np.unique(terms, return_counts=True)
    weights = size * (np.floor(np.log2(counts)) + 1)
    lanes = [_mixed(terms + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)) for k in range(bits // 64)]
    values = np.stack(lanes, axis=1).view(np.uint8).astype(np.int64)
    values += np.arange(values.shape[1]) * 256
    return np.bincount(values.ravel(), np.repeat(weights, values.shape[1]), 32 * bits)


def fingerprint(text, settings=Settings()):
    """Fingerprint of a text in hexadecimal digits; all zeros without words."""
    votes, before = np.zeros(32 * settings.bits), np.empty(0, np.uint64)
    for words in _segments(text):
        if not words:
            continue
        own = _word_hashes(words)
        for size in range(1, settings.longest + 1):
            # Runs that reach into this segment begin in the last words before it.
            lead = before[max(0, len(before) - size + 1) :] if size > 1 else before[:0]
            hashes = np.concatenate([lead, own])
            runs = np.full(max(0, len(hashes) - size + 1), size, np.uint64)
            for k in range(size):
                runs = runs * np.uint64(0x100000001B3) + hashes[k : len(hashes) - size + 1 + k]
            if len(runs):
                votes += _vote(_mixed(runs), size, settings.bits)
        before = np.concatenate([before, own])[-max(1, settings.longest - 1) :]
    if len(text) < settings.short:
        line = " ".join(text.lower().split())
        size = settings.characters
        runs = [line[i : i + size] for i in range(max(1, len(line) - size + 1)) if line]
        if runs:
            votes += _vote(~_word_hashes(runs), 1, settings.bits)
    sums = votes.reshape(settings.bits // 8, 256) @ _SIGNS
    return np.packbits(sums.ravel() > 0).tobytes().hex()


def likeness(a, b):
    """Share of equal bits of two fingerprints."""
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / (4 * len(a))


def add_fingerprints(df, settings=Settings(), text="text", name="fingerprint"):
    """Add the fingerprint of each text; a null text counts as an empty one.

    A narrow stage over whole texts. A column with the name of the added one is replaced.
    """
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([df.schema[c] for c in kept]).add(name, "string")

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py() or "", settings) for t in batch.column(text)]
            columns = [*(batch.column(c) for c in kept), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*kept).mapInArrow(run, schema)


def _blocks(digits, count):
    """(first digit from 0, number of digits) of blocks of about one length."""
    ends = [digits * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def block_tables(digits, radius, rows):
    """(blocks, choices of blocks) so that a key's chance company among ``rows``
    fingerprints stays small: more blocks agree, in more tables, the more rows there are.
    """
    agreeing = 1
    while True:
        blocks = _blocks(digits, radius + agreeing)
        key_bits = 4 * agreeing * min(size for _, size in blocks)
        if key_bits >= math.log2(max(rows, 2)) - 4 or radius + agreeing >= digits // 2:
            return blocks, [*combinations(range(radius + agreeing), agreeing)]
        agreeing += 1


def _distance(a, b, digits):
    """Bits in which two columns of fingerprints differ."""

    def lane(column, k):
        return F.conv(F.substring(column, 16 * k + 1, 16), 16, -10).cast("long")

    lanes = [F.bit_count(lane(a, k).bitwiseXOR(lane(b, k))) for k in range(digits // 16)]
    return sum(lanes[1:], lanes[0])


def search(prints, queries, settings=Settings()):
    """``(query, found, distance)``: every fingerprint of ``prints`` within the radius of
    one of ``queries``, itself left out.

    Both have a column ``fingerprint`` with distinct values and should be stored. A pair
    comes from the first table that holds it, and is compared there: no pair is made
    twice. A key that very many fingerprints share is split by Spark at run time, as
    nothing but the join reads its rows together.
    """
    digits = settings.bits // 4
    blocks, choices = block_tables(digits, settings.radius, prints.count())

    def block(column, place):
        start, size = blocks[place]
        return F.substring(column, start + 1, size)

    def keyed(rows, name):
        keys = [
            F.struct(F.lit(t).alias("table"), F.concat(*[block("fingerprint", p) for p in places]).alias("key"))
            for t, places in enumerate(choices)
        ]
        rows = rows.select(F.col("fingerprint").alias(name), F.explode(F.array(*keys)).alias("_key"))
        return rows.select(name, "_key.table", "_key.key")

    left, right = keyed(queries, "query"), keyed(prints, "found")
    agreeing = F.filter(
        F.array(*[F.when(block("query", p) == block("found", p), F.lit(p)) for p in range(len(blocks))]),
        lambda place: place.isNotNull(),
    )
    choice = F.array(*[F.array(*[F.lit(p) for p in places]) for places in choices])
    first = F.slice(agreeing, 1, len(choices[0])) == F.get(choice, F.col("table"))
    distance = _distance(F.col("query"), F.col("found"), digits)
    pairs = left.join(right, ["table", "key"])
    near = (distance <= settings.radius) & (F.col("query") != F.col("found")) & first
    return pairs.where(near).select("query", "found", distance.alias("distance"))


def count_near(rows, queries, settings=Settings()):
    """``(fingerprint, n_near)`` of the fingerprints of ``queries`` rows: how many other
    rows have a fingerprint within the radius. Equal fingerprints are counted, not
    compared."""
    prints = stage(rows.groupBy("fingerprint").agg(F.count("*").alias("rows")), "fingerprints")
    asked = stage(queries.select("fingerprint").distinct(), "asked-fingerprints")
    pairs = search(prints, asked, settings).select("query", "found")
    sizes = prints.toDF("found", "rows")
    near = pairs.join(sizes, "found").groupBy("query").agg(F.sum("rows").alias("others"))
    own = asked.join(prints, "fingerprint").join(near.withColumnRenamed("query", "fingerprint"), "fingerprint", "left")
    return own.select("fingerprint", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_near"))


def _edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_PAIR = [
    ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
    ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"),
]
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "integer": pa.int32()}


def _compared(text, own, following, next_print, settings):
    edited = _edited(text, following)
    mark = own if edited == text else fingerprint(edited, settings)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), sha, own, mark, likeness(own, mark), likeness(own, next_print)


def against_edited(df, settings=Settings(), key="doc_id", text="text"):
    """Each row's fingerprint beside that of its text with the second half taken from the
    next row, and beside the next row's.

    Rows stand by key, null keys first, rows of one key by a hash of their text; after the
    last comes the first. Columns but the key are left out, null texts are empty. Whole
    texts are dealt out once, in ranges, and read as a stream; only the first and last row
    of each range are written with their text, to meet across the border.
    """
    schema = T.StructType([df.schema[key]])
    for name, kind in [*_PAIR, ("_end", "integer"), ("_part", "integer"), ("_text", "string")]:
        schema = schema.add(name, kind)
    names = schema.names

    def batch_of(rows, key_type):
        types = [key_type, *(_ARROW[f.dataType.typeName()] for f in schema.fields[1:])]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def end(row, which):
        name, value, mark = row
        part = TaskContext.get().partitionId()
        return (name, len(value), None, mark, None, None, None, which, part, value)

    def stream(batches):
        before, kind = None, None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py() or ""
                row = (name, value, fingerprint(value, settings))
                if before is None:
                    out.append(end(row, 0))
                else:
                    found = _compared(before[1], before[2], value, row[2], settings)
                    out.append((before[0], *found, None, None, None))
                before = row
            yield batch_of(out, kind)
        if before is not None:
            yield batch_of([end(before, 1)], kind)

    order = [F.asc_nulls_first(key), F.xxhash64(text)]
    ranged = df.select(key, text).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ranged.mapInArrow(stream, schema), "edited-texts")

    ends = rows.where("_end is not null")
    parts = sorted(r[0] for r in ends.where("_end = 0").select("_part").collect())  # one number per range
    if not parts:
        return rows.drop("_end", "_part", "_text")
    follows = F.create_map(*[F.lit(x) for pair in zip(parts, [*parts[1:], parts[0]]) for x in pair])
    firsts = ends.where("_end = 0").select(
        F.col("_part").alias("_at"), F.col("_text").alias("_next_text"), F.col("fingerprint").alias("_next_print")
    )
    lasts = ends.where("_end = 1").withColumn("_at", F.element_at(follows, F.col("_part")))

    def across(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (key, "_text", "fingerprint", "_next_text", "_next_print")]
            out = [(row[0], *_compared(*row[1:], settings), None, None, None) for row in zip(*columns)]
            yield batch_of(out, batch.schema.field(key).type)

    border = lasts.join(firsts, "_at").mapInArrow(across, schema)
    return rows.where("_end is null").unionByName(border).drop("_end", "_part", "_text")


#: One document in so many is searched for among all others.
ASKED = 100


@query("op11_simhash")
def op11_simhash(spark, sf_dir):
    """``n_near`` is given for documents whose id is divisible by ``ASKED``, the queries of
    the search against all fingerprints."""
    documents = read(spark, sf_dir, "documents")
    rows = stage(against_edited(documents), "fingerprinted")
    asked = F.coalesce(F.col("doc_id") % ASKED == 0, F.lit(False))
    near = count_near(rows, rows.where(asked))
    found = rows.where(asked).join(near, "fingerprint").select(*rows.columns, "n_near")
    return found.unionByName(rows.where(~asked).withColumn("n_near", F.lit(None).cast("long")))
