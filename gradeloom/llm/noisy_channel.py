"""Toxicity of texts after noisy-channel deobfuscation.

A word that looks disguised (symbols or digits for letters, stretched letters, letters
apart) becomes a lattice of the characters that each of its characters may stand for.
Viterbi decoding under a character trigram model of the whole corpus picks the likeliest
reading, and the restored words are scored.

Evidence is the log-odds of words and word beginnings between toxic and other labelled
texts. A logistic curve over the strongest evidence of a text, fitted on labelled rows
that did not choose the evidence, gives the score.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

ALPHABET = "abcdefghijklmnopqrstuvwxyzàáâäçèéêëíîïñóôöùúûüßœæåø"
SYMBOLS = 64  # 0 is everything that is no letter of the alphabet
CACHED_WORDS = 400_000
#: Characters that are counted at a time, whatever a batch or a text holds.
PIECE = 1 << 20
CACHED_WORD_CHARS = 48
THRESHOLD = 0.7

#: What a character may stand for besides itself.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou", "#": "h", "%": "o", "&": "a",
}
SUBSTITUTED, DROPPED, DIGIT_DROPPED, SHORTENED, KEPT = -1.0, -1.5, -6.0, -0.2, -12.0

_CORE = re.compile(r"(?:(?<![$@])[$@](?=[^\W\d_]))?[^\W_](?:.*[^\W_])?", re.DOTALL)
_STRETCHED = re.compile(r"(.)\1\1", re.DOTALL)
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[ .\-_*][^\W\d_]){3,}(?!\S)")
_SYMBOL_OF = {c: i + 1 for i, c in enumerate(ALPHABET)}
_TO_SYMBOL = np.zeros(0x110000, np.uint8)
for _c, _i in _SYMBOL_OF.items():
    _TO_SYMBOL[ord(_c)] = _TO_SYMBOL[ord(_c.upper()) if len(_c.upper()) == 1 else ord(_c)] = _i


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows the evidence is fitted on (those with
    the smallest hash of their key); it and ``min_toxic_texts`` bound the words and
    beginnings whose log-odds are worked out.

    An entry's weight is its log-odds less ``errors_below`` standard errors, so that
    words that fell into toxic texts by chance carry none.
    """

    sample_rows: int = 20_000
    min_toxic_texts: int = 6
    min_log_odds: float = 1.0
    errors_below: float = 2.0
    beginnings: tuple = (4, 5, 6)


class LanguageModel:
    """Character trigrams with back-off, from counts of symbol triples."""

    def __init__(self, counts):
        triples = np.asarray(counts, np.float64).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        pairs = triples.sum(0)
        singles = pairs.sum(0) + 1.0
        one = singles / singles.sum()
        two = (pairs + 5.0 * one) / (pairs.sum(1, keepdims=True) + 5.0)
        three = (triples + 5.0 * two) / (triples.sum(2, keepdims=True) + 5.0)
        self.log = np.log(three).tolist()


def symbol_counts(text):
    """How often each symbol triple stands in a text, by its code."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _TO_SYMBOL[codes].astype(np.int32)
    triples = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    return np.bincount(triples, minlength=1)


def _pieces(texts):
    """Texts, parted and ended by line breaks, in pieces of about ``PIECE`` characters.

    A text that is cut gives both sides the two characters at the cut, so that every
    triple is counted and none twice.
    """
    held, size = ["\n\n"], 2
    for text in filter(None, texts):
        start = 0
        while len(text) - start > PIECE:
            yield "".join([*held, text[start : start + PIECE]])
            start += PIECE
            held, size = [text[start - 2 : start]], 2
        held += [text[start:], "\n\n"]
        size += len(text) - start + 2
        if size >= PIECE:
            yield "".join(held)
            held, size = ["\n\n"], 2
    if size > 2:
        yield "".join(held)


def fit_language_model(df, text="text"):
    """Model of all texts. Each task adds up its texts, a piece at a time; the sums of a
    fixed number of triples go to the driver. Without texts all characters are alike."""

    def count_batches(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for piece in _pieces(t.as_py() for t in batch.column(0) if t.is_valid):
                found = symbol_counts(piece)
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["triple", "n"]
        )

    counted = df.select(text).mapInArrow(count_batches, "triple int, n long")
    rows = counted.groupBy("triple").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**3)
    counts[rows["triple"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return LanguageModel(counts)


def lattice(word):
    """[[(characters, log-probability)]] for each run of equal characters."""
    steps = []
    for run in re.finditer(r"(.)\1*", word, re.DOTALL):
        char, length = run[1], len(run[0])
        alternatives = LOOKS_LIKE.get(char, "")
        if char in _SYMBOL_OF:
            options = [(char * min(length, 2), 0.0)]
            if length > 2:
                options.append((char, SHORTENED))
        else:
            options = [("", DIGIT_DROPPED if char.isdigit() else DROPPED), (char, KEPT)]
        options += [(c, SUBSTITUTED) for c in alternatives]
        if length == 2:
            options += [(c * 2, SUBSTITUTED) for c in alternatives]
        steps.append(options)
    return steps


def decode(word, log):
    """Likeliest reading of a word under the trigram log-probabilities."""
    symbol = _SYMBOL_OF.get
    best = {(0, 0): (0.0, ())}
    for options in lattice(word):
        following = {}
        for (a, b), (score, path) in best.items():
            for characters, cost in options:
                x, y, total = a, b, score + cost
                for c in characters:
                    z = symbol(c, 0)
                    total += log[x][y][z]
                    x, y = y, z
                if (x, y) not in following or following[x, y][0] < total:
                    following[x, y] = total, (path, characters)
        best = following
    ends = ((score + log[a][b][0], path) for (a, b), (score, path) in best.items())
    _, path = max(ends, key=lambda e: e[0])
    pieces = []
    while path:
        path, characters = path
        pieces.append(characters)
    return "".join(reversed(pieces))


def disguised(word):
    """Letters mixed with what may stand for letters, or stretched letters."""
    return not word.isdigit() and (not word.isalpha() or _STRETCHED.search(word) is not None)


class Reader:
    """Words of texts with disguises undone, as evidence keys."""

    def __init__(self, log, beginnings):
        self._log, self._beginnings = log, beginnings

    def word(self, token):
        """The restored word of a token, or an empty string."""
        core = _CORE.search(token.lower())
        if core is None:
            return ""
        word = core[0]
        if disguised(word):
            if not any(c.isalpha() for c in word):
                return ""
            word = decode(word, self._log)
        return word

    def keys(self, token):
        """The restored word and its beginnings."""
        word = self.word(token)
        return ["=" + word, *[word[:n] for n in self._beginnings if len(word) > n]] if word else []

    def spaced(self, text):
        """Words whose letters stand apart, put together."""
        return [re.sub(r"[^\w]|_", "", m[0]) for m in _SPACED.finditer(text)]

    def all_keys(self, text):
        """Distinct keys of a text."""
        tokens = set(text.split())
        tokens.update(self.spaced(text))
        return {key for token in tokens for key in self.keys(token)}


@dataclass
class Model:
    log: list
    beginnings: tuple
    weights: dict
    curve: tuple = (-3.0, 0.0)
    _reader: Reader = field(default=None, repr=False)
    _cache: dict = field(default_factory=dict, repr=False)

    def _evidence(self, token):
        if self._reader is None:
            self._reader = Reader(self.log, self.beginnings)
        found = max((self.weights.get(k, 0.0) for k in self._reader.keys(token)), default=0.0)
        if len(token) <= CACHED_WORD_CHARS:
            if len(self._cache) >= CACHED_WORDS:
                self._cache.clear()
            self._cache[token] = found
        return found

    def evidence(self, text):
        """Sum of the weights of the two words that weigh most."""
        tokens = text.split()
        values = [*map(self._cache.get, tokens)]
        if None in values:
            for i, value in enumerate(values):
                if value is None:
                    values[i] = self._evidence(tokens[i])
        if _SPACED.search(text):
            values += map(self._evidence, Reader(self.log, self.beginnings).spaced(text))
        if not any(values):
            return 0.0
        strongest = sorted((v for v in values if v), reverse=True)[:2]
        return sum(strongest)

    def score(self, text):
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * self.evidence(text or "")))))


def held_out(key="doc_id"):
    """Rows whose labels are never learned from."""
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def _training_rows(df, labels, key, label, settings):
    """Text and label of a bounded sample of the rows that may be learned from."""
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
        .select(F.col(key).alias("_key"), F.col(label).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_key"), "_key", "toxic")
        .limit(settings.sample_rows)
        .groupBy("_key")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = df.select(F.col(key).alias("_key"), F.col("text"))
    joined = texts.join(F.broadcast(chosen), "_key").where("text is not null")
    part = F.pmod(F.xxhash64(F.lit("curve"), "_key"), F.lit(3)) == 0
    return stage(joined.select("text", "toxic", part.alias("for_curve")), "toxic-sample")


def _count_keys(rows, log, beginnings, wanted=None):
    """(key, texts that hold it); within a batch it is counted once per text."""

    def count_batches(batches):
        reader = Reader(log, beginnings)
        for batch in batches:
            counts = Counter()
            for text in batch.column(0).to_pylist():
                keys = reader.all_keys(text)
                counts.update(keys if wanted is None else keys & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["key", "n"],
            )

    counted = rows.select("text").mapInArrow(count_batches, "key string, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def _logistic(inputs, targets):
    """Weights of a logistic curve by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(inputs)), inputs])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (targets - p) - 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hessian, gradient), -4, 4)
    return tuple(map(float, w))


def fit(df, labels, key="doc_id", label="toxic", settings=Settings()):
    """A model from all texts of ``df`` (characters) and its labelled rows (evidence).

    Without toxic rows to learn from every text gets the same low score.
    """
    log = fit_language_model(df).log
    rows = _training_rows(df, labels, key, label, settings)
    sizes = {(r.toxic, r.for_curve): r["count"] for r in rows.groupBy("toxic", "for_curve").count().collect()}
    toxic, other = sizes.get((1, False), 0), sizes.get((0, False), 0)
    model = Model(log, settings.beginnings, {})
    if not toxic or not other:
        return model
    fitted = rows.where("not for_curve")
    frequent = _count_keys(fitted.where("toxic = 1"), log, settings.beginnings).where(
        F.col("n") >= settings.min_toxic_texts
    )
    in_toxic = {r.key: r.n for r in frequent.collect()}
    in_other = {
        r.key: r.n
        for r in _count_keys(fitted.where("toxic = 0"), log, settings.beginnings, set(in_toxic)).collect()
    }
    for entry, n in in_toxic.items():
        m = in_other.get(entry, 0)
        odds = math.log((n + 0.5) / (toxic + 1)) - math.log((m + 0.5) / (other + 1))
        odds -= settings.errors_below * math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5 + other / toxic))
        if odds >= settings.min_log_odds:
            model.weights[entry] = odds

    def evidence_batches(batches):
        for batch in batches:
            found = [model.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], ["x", "y"])

    held = rows.where("for_curve").select("text", F.col("toxic").cast("double"))
    points = held.mapInArrow(evidence_batches, "x double, y double").toPandas()
    if points["y"].nunique() == 2:
        model.curve = _logistic(points[["x"]].to_numpy(), points["y"].to_numpy())
    return model


def score(df, model, text="text", name="score", threshold=THRESHOLD):
    """Add the score (0 to 1) and ``predicted`` (1 from the threshold on).

    One narrow stage over whole texts. A null or empty text has no evidence and gets
    the lowest score. Repeated rows are kept; columns named like an added one are
    replaced.
    """
    kept = [c for c in df.columns if c not in (name, "predicted")]
    schema = T.StructType([df.schema[c] for c in kept]).add(name, "double").add("predicted", "integer")

    def score_batches(batches):
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(text)]
            flags = pa.array([int(s >= threshold) for s in scores], pa.int32())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), flags], schema.names)

    return df.select(*kept).mapInArrow(score_batches, schema)


@query("op7_noisy_channel")
def op7_noisy_channel(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, read(spark, sf_dir, "labels"))
    return score(documents, model).drop("text").withColumn("held_out", held_out())
