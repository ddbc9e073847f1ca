"""Substring dedup by sliding spans of sentences.

From every sentence on, the shortest run of at least ``SENTENCES`` sentences with at
least ``WORDS`` words is a span. All spans of all texts are counted by a hash of their
words; sentences that lie in a span which stands earlier in the corpus are removed.

A long sentence is cut after each clause, and a long clause where the words themselves
say so, so that a shared passage is cut alike wherever it starts. Scripts without spaces
count by characters.

Only hashes are shuffled. The spans are written once, as one row of arrays per text; those
that stand once are dropped from it by a filter of fixed size over the repeated ones, and
texts without a repeated span are not moved at all.
"""

import itertools
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.filters import filter_of, held, split
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

SENTENCES = 2
WORDS = 12
LONG_SENTENCE = 24
CLAUSE = 12
FILTER_BITS = 1 << 25
#: Letters and signs of scripts that set no spaces between words, and how many count as a word.
_DENSE = "\u0e00-\u109f\u1780-\u17ff\u3001-\u30ff\u3400-\u9fff\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff"
DENSE_WORD = 2
_FULL = "。！？｡．؟۔।॥።։။។༎།"
_END = re.compile(
    rf"[.!?\n{_FULL}](?:(?<=[.!?])[.!?]*[^\w\s]*(?:\s+|\Z)|(?<=\n)\s*|(?<=[{_FULL}])[{_FULL}]*[」』】）〕》〉”’\"')]*\s*)"
)
_UNIT = re.compile(rf"[{_DENSE}]\s*|[^\s{_DENSE}]+\s*")
_WORD = re.compile(r"\S+\s*")
_DENSE = re.compile(f"[{_DENSE}]")
_CLAUSE_END = re.compile(r"[,;:|،؛](?:\s+|\Z)|[，、；：]\s*")
_BEFORE = np.arange(CLAUSE)[::-1]
_word_hash = lru_cache(1 << 16)(lambda word: xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")))


def _size(text, dense):
    """Number of words; where scripts without spaces stand, so many characters are a word."""
    if not dense:
        return len(text.split())
    rest, characters = _DENSE.subn(" ", text)
    return len(rest.split()) + characters // DENSE_WORD


def _is_dense(text):
    return not text.isascii() and _DENSE.search(text) is not None


def _split(text, ends):
    places = [0, *ends, len(text)]
    return [text[a:b] for a, b in itertools.pairwise(places) if a < b]


def _cut_clause(clause, dense):
    """Parts of a clause, of at most ``CLAUSE`` words each.

    Of each ``CLAUSE`` words in a row, the last one with the least hash (taken with the word
    before it) ends a part. So the words around a place decide, not where the clause starts.
    """
    words = _UNIT.findall(clause) if dense else clause.split()
    if len(words) <= CLAUSE:
        return [clause]
    bare = map(str.rstrip, words) if dense else words
    hashes = np.fromiter(map(_word_hash, bare), np.uint64, len(words))
    hashes[1:] += hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    windows = np.arange(len(words) - CLAUSE + 1)
    least = hashes[windows[:, None] + _BEFORE].argmin(1)
    ends = [found.end() for found in (_UNIT if dense else _WORD).finditer(clause)]
    return _split(clause, [ends[n] for n in dict.fromkeys((windows + CLAUSE - 1 - least).tolist())])


def sentences(text):
    """Parts of a text that together are the text; a long sentence is several parts."""
    dense = _is_dense(text)
    parts = []
    for sentence in _split(text, [found.end() for found in _END.finditer(text)]):
        if len(sentence) <= 2 * LONG_SENTENCE or _size(sentence, dense) <= LONG_SENTENCE:
            parts.append(sentence)
            continue
        for clause in _split(sentence, [found.end() for found in _CLAUSE_END.finditer(sentence)]):
            parts += _cut_clause(clause, dense) if len(clause) > CLAUSE else [clause]
    return parts


def spans(parts):
    """(hash, first part, number of parts) of each span."""
    words = [p.split() for p in parts]
    plain = [" ".join(w) for w in words]
    dense = _is_dense("".join(parts))
    if dense:
        plain = [w + " " * (w != "" and p[-1].isspace()) for w, p in zip(plain, parts)]
    sizes = [_size(p, dense) for p in parts] if dense else map(len, words)
    ends = [0, *itertools.accumulate(sizes)]
    found = []
    last = 0
    for first in range(len(parts)):
        last = max(last, first + SENTENCES)
        while last <= len(parts) and ends[last] - ends[first] < WORDS:
            last += 1
        if last > len(parts):
            break
        joined = "".join(plain[first:last]).rstrip() if dense else " ".join(filter(None, plain[first:last]))
        digest = xxhash.xxh3_128_digest(joined.encode("utf-8", "surrogatepass"))
        found.append((*struct.unpack("<2q", digest), first, last - first))
    return found


_SPANS = "doc long, ha array<long>, hb array<long>, first array<int>, n array<int>"
#: Spans of the texts that go into one batch.
BATCH_SPANS = 50_000


def _span_batches(batches):
    """The spans of each text that has any, as arrays."""
    docs, rows, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = spans(sentences(text.as_py() or ""))
            if found:
                docs.append(doc)
                rows.append(np.array(found, np.int64))
                size += len(found)
            if size >= BATCH_SPANS:
                yield _span_arrays(docs, rows)
                docs, rows, size = [], [], 0
    if docs:
        yield _span_arrays(docs, rows)


def _span_arrays(docs, rows):
    offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
    ha, hb, first, n = np.concatenate(rows).T
    values = [pa.array(ha), pa.array(hb), pa.array(first, pa.int32()), pa.array(n, pa.int32())]
    lists = [pa.ListArray.from_arrays(offsets, column) for column in values]
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *lists], ["doc", "ha", "hb", "first", "n"])


def _repeated_batches(wanted):
    """(ha, hb, doc, first, n) of the spans that the filter may hold."""

    def run(batches):
        for batch in batches:
            ha, hb, first, n = (
                batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ha", "hb", "first", "n")
            )
            lengths = batch.column("ha").value_lengths().to_numpy(zero_copy_only=False)
            docs = np.repeat(batch.column("doc").to_numpy(zero_copy_only=False), lengths)
            at = np.flatnonzero(held(wanted, ha.view(np.uint64), FILTER_BITS))
            columns = [pa.array(c[at]) for c in (ha, hb, docs, first, n)]
            yield pa.RecordBatch.from_arrays(columns, ["ha", "hb", "doc", "first", "n"])

    return run


def _covered(df):
    """(doc, firsts, counts) of the spans of each text that stand earlier."""
    made = stage(df.select("doc", "text").mapInArrow(_span_batches, _SPANS), "spans")
    each = F.explode(F.arrays_zip("ha", "hb", "first"))
    each = made.select("doc", each.alias("_span")).select("_span.ha", "_span.hb", "doc", "_span.first")
    repeated = each.groupBy("ha", "hb").agg(F.count("*").alias("rows"), F.min(F.struct("doc", "first")).alias("head"))
    repeated = stage(repeated.where("rows > 1").select("ha", "hb", "head"), "repeated-spans")
    wanted = filter_of(repeated, "ha", FILTER_BITS)
    again = made.mapInArrow(_repeated_batches(wanted), "ha long, hb long, doc long, first int, n int")
    later = again.join(repeated, ["ha", "hb"]).where("head.doc != doc or head.first != first")
    return stage(
        later.groupBy("doc").agg(F.collect_list("first").alias("_firsts"), F.collect_list("n").alias("_counts")),
        "covered-sentences",
    )


def cut(text, firsts, counts):
    """(text without the sentences that the given spans cover, their number)."""
    parts = sentences(text)
    gone = np.zeros(len(parts) + 1, np.int64)
    np.add.at(gone, firsts, 1)
    np.add.at(gone, np.add(firsts, counts), -1)
    gone = np.cumsum(gone[:-1]) > 0
    return "".join([p for p, g in zip(parts, gone) if not g]), int(gone.sum())


def remove_repeated_sentences(df, key="doc_id", text="text"):
    """``df`` with ``text`` cut, and the number of sentences gone in ``n_cut``.

    The first place is that with the smallest key, then the first in the text. A null
    key comes before all others; rows that repeat a key and a text are one text and
    are cut alike; a key is expected to name one text. A null text stays null, an empty one empty. A
    column named ``n_cut`` is replaced.
    """
    df = df.drop("n_cut")
    names = df.columns
    whole = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    covered = _covered(df.select(whole.alias("doc"), F.col(text).alias("text")))
    marked = df.withColumn("_doc", whole)
    schema = T.StructType([*df.schema.fields]).add("n_cut", "long")

    def cut_batches(batches):
        for batch in batches:
            texts, n_cut = [], []
            for value, firsts, counts in zip(*(batch.column(c) for c in (text, "_firsts", "_counts"))):
                value, n = value.as_py(), 0
                if value and firsts.is_valid:
                    value, n = cut(value, np.asarray(firsts.values), np.asarray(counts.values))
                texts.append(value)
                n_cut.append(n)
            place = batch.schema.get_field_index(text)
            columns = [batch.column(c) for c in names]
            columns[names.index(text)] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_cut, pa.int64())], [*names, "n_cut"])

    same, moved = split(marked, covered.select(F.col("doc").alias("_doc")), "_doc")
    same = same.select(*names).withColumn("n_cut", F.lit(0).cast("long"))
    moved = moved.join(covered.withColumnRenamed("doc", "_doc"), "_doc", "left")
    moved = moved.select(*names, "_firsts", "_counts").mapInArrow(cut_batches, schema)
    return same.unionByName(moved)


@query("op5_sentence_spans")
def op5_sentence_spans(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.coalesce("text", F.lit(""))
    return remove_repeated_sentences(documents).select(
        "doc_id",
        "n_cut",
        F.length(kept).cast("long").alias("n_kept"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
