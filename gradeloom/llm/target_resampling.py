"""Resampling of documents towards a target distribution, by hashed word runs.

Every run of words falls into one of a fixed number of buckets. The array of bucket
gains (log ratio of target to source share) scores a whole text in one narrow pass, and
noise derived from the document's id turns the highest scores into a draw without
replacement in proportion to the weights.

The cutoff of the draw is found without sorting the table: a quantile sketch proposes a
bracket of scores around it, the rows above and inside the bracket are counted exactly,
and a bracket that misses the cutoff is widened. Only the bracket is sorted.
"""

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.operators.ordering import number_rows
from gradeloom.sources.staging import stage

#: Bytes of a text that are cut into words at a time.
SEGMENT = 1 << 20
_WORD_BYTES = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_CLEAN = bytes(
    b if b in _WORD_BYTES else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    """``longest`` is the longest run of words that counts as a feature. Of the documents
    with ``min_words`` words, ``percent`` in a hundred are drawn. ``accuracy`` is the size
    of the quantile sketch and ``margin`` the share of rows that the first bracket takes
    on either side of the cutoff; neither changes the result."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: str = "2024"
    scale: int = 1000
    accuracy: int = 1024
    margin: float = 0.005


def _segments(text):
    """Words of a text in lists, each from about ``SEGMENT`` bytes.

    Only A-Z are lowered, bytes that are no digit, letter or part of a longer character
    part the words; a cut between segments falls on such a byte.
    """
    clean = text.encode("utf-8", "surrogatepass").translate(_CLEAN)
    start = 0
    while len(clean) - start > SEGMENT:
        stop = clean.find(b" ", start + SEGMENT)
        if stop < 0:
            break
        yield clean[start:stop].split()
        start = stop
    yield clean[start:].split()


def text_buckets(text, settings):
    """(number of words, arrays with the bucket of every feature) of a text."""
    words, arrays, before = 0, [], []
    for found in _segments(text):
        words += len(found)
        for size in range(1, settings.longest + 1):
            # Runs that reach into this segment begin in the last words before it.
            own = [*before[len(before) - size + 1 :], *found] if size > 1 else found
            runs = own if size == 1 else map(b" ".join, zip(*(own[i:] for i in range(size))))
            codes = np.fromiter(map(zlib.crc32, runs), np.uint32)
            arrays.append(codes % np.uint32(settings.buckets))
        if settings.longest > 1:
            before = [*before, *found][-(settings.longest - 1) :]
    return words, arrays


def bucket_counts(df, settings=Settings(), text="text"):
    """How many features of all texts fall into each bucket, as an array.

    A task adds up all its rows first, so at most one row per bucket and task is moved
    and one number per bucket reaches the driver. Null texts have no features.
    """

    def count(batches):
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for codes in text_buckets(value.as_py() or "", settings)[1]:
                    total += np.bincount(codes, minlength=settings.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"]
        )

    counted = df.select(text).mapInArrow(count, "bucket int, n long")
    counts = np.zeros(settings.buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(source, target, settings=Settings()):
    """Gain of a feature in each bucket: the rounded-down log ratio of smoothed shares."""
    s_all, t_all = int(source.sum()) + settings.buckets, int(target.sum()) + settings.buckets
    return np.array(
        [
            math.floor(settings.scale * math.log(float(t + 1) * s_all / (float(s + 1) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def add_weights(df, gains, settings=Settings(), text="text"):
    """Add ``n_words``, ``n_features`` and ``weight``, the sum of the gains of all features.

    A narrow stage over whole texts; only these columns and the others of ``df`` leave it.
    Columns with the names of added ones are replaced, null and empty texts weigh 0.
    """
    added = ("n_words", "n_features", "weight")
    kept = [c for c in df.columns if c not in added]
    passed = [c for c in kept if c != text]
    schema = T.StructType([df.schema[c] for c in passed])
    for name in added:
        schema = schema.add(name, "long")

    def weigh(batches):
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), np.int64)
            for i, value in enumerate(batch.column(text)):
                words, arrays = text_buckets(value.as_py() or "", settings)
                rows[0, i] = words
                rows[1, i] = sum(map(len, arrays))
                rows[2, i] = sum(int(gains[codes].sum()) for codes in arrays)
            columns = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, rows)], schema.names)

    return df.select(*kept).mapInArrow(weigh, schema)


def noise(key, settings=Settings()):
    """Gumbel noise of a key, rounded down: the same key always gets the same."""
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digits = F.substring(F.sha2(name.cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-float(settings.scale) * F.log(-F.log(share)))


def _bracket(rows, wanted, total, settings):
    """(low, high, rows above high): the row at place ``wanted`` from the top scores
    between low and high, as exact counts show."""
    sketch = rows.agg(F.kll_sketch_agg_bigint("score", settings.accuracy).alias("sketch"))
    margin = settings.margin
    while True:
        ends = [max(0.0, 1 - wanted / total - margin), min(1.0, 1 - wanted / total + margin)]
        if margin >= 1:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        else:
            low, high = sketch.select(
                *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(end)) for end in ends]
            ).first()
        above, inside = rows.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < wanted <= above + inside:
            return low, high, above
        margin = max(4 * margin, 1e-4)


def draw(scored, settings=Settings(), key="doc_id"):
    """Add ``rank``, from 1 for the highest score, null for rows that are not drawn.

    ``scored`` has the key, ``n_words`` and ``score`` and is read several times, so it
    should be stored. Ties go to the smaller key, null keys first; rows that are alike in
    both are drawn one by one. Too few rows for a whole draw leave all ranks null. A hot
    score only makes the bracket larger, which is sorted in ranges of score and key.
    """
    scored = scored.drop("rank")
    able = scored.where(F.col("n_words") >= settings.min_words)
    total = able.count()
    wanted = settings.percent * total // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    low, high, above = _bracket(able.select("score"), wanted, total, settings)
    order = [F.desc("score"), F.asc_nulls_first(key)]
    may = F.col("n_words") >= settings.min_words
    over = may & (F.col("score") > high)
    inside = may & F.col("score").between(low, high)
    # The drawn rows above the bracket are ranked on their own, in ranges.
    first = number_rows(scored.where(over), order, "rank")
    rest = number_rows(scored.where(inside), order, "rank")
    place = F.col("rank") + F.lit(above)
    rest = rest.withColumn("rank", F.when(place <= wanted, place))
    out = scored.where(~(over | inside)).withColumn("rank", F.lit(None).cast("long"))
    names = [*scored.columns, F.col("rank").cast("long").alias("rank")]
    return out.unionByName(first.select(*names)).unionByName(rest.select(*names))


def resample(df, target, settings=Settings(), key="doc_id", text="text"):
    """Every row of ``df`` with its weight towards ``target``, its score and its rank.

    The text itself is left out. An empty ``df`` gives an empty result, an empty
    ``target`` gives weights by the smoothing alone.
    """
    source = bucket_counts(df, settings, text)
    gains = bucket_gains(source, bucket_counts(target, settings, text), settings)
    weighed = add_weights(df.drop("score", "rank"), gains, settings, text)
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(key, settings)), "weights")
    return draw(scored, settings, key)


_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
#: A word's bytes from its code points, and the checksum of bytes bit by bit.
_SQL = rf"""WITH RECURSIVE
source AS (SELECT doc_id, {_WORDS} AS words FROM documents),
target AS (SELECT {_WORDS} AS words FROM benchmark),
steps AS (SELECT i AS b, i AS c, 0 AS k FROM range(256) AS r(i)
 UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
 FROM steps WHERE k < 8),
codes AS (SELECT list(c ORDER BY b) AS code FROM steps WHERE k = 8),
places AS (SELECT doc_id, unnest(words) AS word FROM source),
aims AS (SELECT unnest(words) AS word FROM target),
counts AS (SELECT word, sum(s) AS s, sum(t) AS t FROM
 (SELECT word, count(*) AS s, 0 AS t FROM places GROUP BY word
  UNION ALL SELECT word, 0, count(*) FROM aims GROUP BY word) AS u GROUP BY word),
named AS (SELECT word, s, t, hex(encode(word)) AS digits FROM counts),
walk AS (SELECT word, digits, 1 AS pos, CAST(4294967295 AS BIGINT) AS c FROM named
 UNION ALL
 SELECT word, digits, pos + 2,
  xor(c >> 8, code[xor(c & 255, (instr('0123456789ABCDEF', substr(digits, pos, 1)) - 1) * 16
   + instr('0123456789ABCDEF', substr(digits, pos + 1, 1)) - 1) + 1])
 FROM walk, codes WHERE pos <= length(digits)),
hashed AS (SELECT n.word, n.s, n.t, xor(w.c, 4294967295) % 10000 AS bucket
 FROM named n JOIN walk w ON n.word = w.word AND w.pos > length(w.digits)),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM hashed),
gains AS (SELECT bucket, floor(1000 * ln(CAST(sum(t) + 1 AS DOUBLE) * CAST(max(all_s) + 10000 AS DOUBLE)
  / (CAST(sum(s) + 1 AS DOUBLE) * CAST(max(all_t) + 10000 AS DOUBLE)))) AS gain
 FROM hashed, totals GROUP BY bucket),
weights AS (SELECT p.doc_id, sum(g.gain) AS weight FROM places p JOIN hashed h ON p.word = h.word
 JOIN gains g ON h.bucket = g.bucket GROUP BY p.doc_id),
scored AS (SELECT s.doc_id, CAST(coalesce(len(s.words), 0) AS BIGINT) AS n_features,
 CAST(coalesce(w.weight, 0) AS BIGINT) AS weight,
 CAST(coalesce(w.weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(
  sha256('2024:' || CAST(s.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
 FROM source s LEFT JOIN weights w ON s.doc_id = w.doc_id),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
 count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score,
 CAST(CASE WHEN o.place <= (10 * o.n) // 100 THEN o.place END AS BIGINT) AS rank
FROM scored s LEFT JOIN ordered o ON s.doc_id = o.doc_id"""


@query("op13_target_resampling", _SQL)
def op13_target_resampling(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(documents, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
