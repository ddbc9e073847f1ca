"""BPE encoding and decoding with a contiguous rank array per word.

A word is held as a list of part boundaries and a list of the merge ranks of
neighbouring parts. The lowest rank is found by scanning, the boundary between the
two parts goes, and the two ranks beside it are looked up again. Words longer than
``LONG_WORD`` parts take the same merges from a heap, since scanning is quadratic.

Texts are split at ASCII white space. No merge and no normalisation crosses it, so
each distinct piece is encoded once per worker and looked up from then on.
"""

import hashlib
import heapq
import json
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read

LONG_WORD = 64
CACHED_PIECES = 300_000
CACHED_WORDS = 600_000
CACHED_PIECE_CHARS = 64
#: Pieces of these characters are cut here as the library cuts them.
_LETTERS = "a-zß-öø-ÿ"
_SIMPLE = re.compile(rf"[!-;=-~À-ÖØ-Þ{_LETTERS[3:]}]+")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def _byte_names():
    """The printable character that stands for each byte in byte-level files."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_NAMES = _byte_names()
_MODELS = {}


class RankArrayBpe:
    """Encoder and decoder for a ``tokenizers`` file whose model is BPE.

    Pieces of ASCII and Latin-1 letters are cut into words here, others by the file's
    own normaliser and pre-tokeniser; the merges are done here.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens = {number: token for token, number in self.vocabulary.items()}
        self.ranks = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[left, right] = rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({number: token for token, number in self.special.items()})
        found = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        self._word_cache, self._ids, self._decoded = {}, {}, {}

    def merge(self, word):
        """Token strings of one pre-tokenised word."""
        parts = list(word)
        if not parts:
            return parts
        parts[-1] += self.suffix
        return self._merge_long(parts) if len(parts) > LONG_WORD else self._merge_short(parts)

    def _merge_short(self, parts):
        ranks, none = self.ranks, len(self.ranks)
        beside = [ranks.get(pair, none) for pair in zip(parts, parts[1:])]
        while beside:
            lowest = min(beside)
            if lowest == none:
                break
            at = beside.index(lowest)
            parts[at] += parts.pop(at + 1)
            beside.pop(at)
            if at:
                beside[at - 1] = ranks.get((parts[at - 1], parts[at]), none)
            if at < len(beside):
                beside[at] = ranks.get((parts[at], parts[at + 1]), none)
        return parts

    def _merge_long(self, parts):
        ranks = self.ranks
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = [(ranks[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            behind = after[at]
            if parts[at] != left or behind < 0 or parts[behind] != right:
                continue
            parts[at], parts[behind] = left + right, None
            after[at] = after[behind]
            if after[at] >= 0:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] >= 0:
                    pair = parts[i], parts[after[i]]
                    if pair in ranks:
                        heapq.heappush(heap, (ranks[pair], i, *pair))
        return [p for p in parts if p is not None]

    def _words(self, piece):
        if _SIMPLE.fullmatch(piece):
            words = _WORD.findall(piece.lower())
            if piece.isascii():
                return words
            return ["".join(map(_BYTE_NAMES.__getitem__, w.encode())) for w in words]
        if self._normalizer is not None:
            piece = self._normalizer.normalize_str(piece)
        return [word for word, _ in self._splitter.pre_tokenize_str(piece)]

    def _encode_word(self, word):
        """(ids as decimals, tokens) of a word, looked up if it was seen before."""
        found = self._word_cache.get(word)
        if found is None:
            tokens = self.merge(word)
            ids = [self.vocabulary[token] for token in tokens]
            found = " ".join(map(str, ids)), " ".join(tokens)
            if len(word) <= CACHED_PIECE_CHARS:
                if len(self._word_cache) >= CACHED_WORDS:
                    self._word_cache.clear()
                self._word_cache[word] = found
        return found

    def _encode_piece(self, piece):
        """[(ids as decimals, tokens)] of a piece without ASCII white space."""
        if not self._special or not self._special.search(piece):
            return [*map(self._encode_word, self._words(piece))]
        found = []
        for part in self._special.split(piece):
            if part in self.special:
                found.append((str(self.special[part]), part))
            elif part:
                found += map(self._encode_word, self._words(part))
        return found

    def encode(self, text):
        """Token ids of a text; None counts as empty."""
        return [*map(int, self.encode_decode(text)[1].split())]

    def decode(self, ids):
        """The tokens with one space between; such a file names no decoder."""
        return " ".join(self.tokens[number] for number in ids)

    def _add_piece(self, piece):
        found = self._encode_piece(piece)
        if len(found) == 1:
            ids, decoded = found[0]
        else:
            ids, decoded = " ".join([x for x, _ in found]), " ".join([x for _, x in found])
        if len(piece) <= CACHED_PIECE_CHARS:
            if len(self._ids) >= CACHED_PIECES:
                self._ids.clear()
                self._decoded.clear()
            self._ids[piece], self._decoded[piece] = ids, decoded
        return ids, decoded

    def encode_decode(self, text):
        """(number of ids, ids as decimals, decoded text), each piece looked up."""
        text = text or ""
        for space in "\t\n\r\f\v":
            text = text.replace(space, " ")
        pieces = text.split(" ")
        ids = [*map(self._ids.get, pieces)]
        decoded = [*map(self._decoded.get, pieces)]
        if None in ids:
            for i, known in enumerate(ids):
                if known is None:
                    # Taken from the result: the caches may be cleared on the way.
                    ids[i], decoded[i] = self._add_piece(pieces[i])
        joined = " ".join(filter(None, ids))
        return joined.count(" ") + bool(joined), joined, " ".join(filter(None, decoded))


def _model(path):
    if path not in _MODELS:
        _MODELS[path] = RankArrayBpe(path)
    return _MODELS[path]


def encode_decode_digests(df, path, text="text"):
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of a text column.

    One narrow stage over whole texts. A null text counts as empty: no tokens and the
    digests of the empty string. Repeated rows are kept, other columns pass through;
    columns that already have one of the three names are replaced.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = df.drop(*added).withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    schema = kept.drop("_text").schema.add("n_tokens", "long")
    schema = schema.add("ids_sha256", "string").add("decoded_sha256", "string")

    def encode_batches(batches):
        model = _model(path)
        for batch in batches:
            place = batch.schema.get_field_index("_text")
            rows = [model.encode_decode(t.as_py()) for t in batch.column(place)]
            digests = [
                pa.array([hashlib.sha256(r[i].encode()).hexdigest() for r in rows], pa.string())
                for i in (1, 2)
            ]
            others = [c for i, c in enumerate(batch.columns) if i != place]
            names = [n for i, n in enumerate(batch.schema.names) if i != place]
            counts = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*others, counts, *digests], [*names, *added])

    return kept.mapInArrow(encode_batches, schema)


def encode(df, path, text="text", ids="ids"):
    """Add the token ids of ``text`` as an array of int; null counts as empty."""
    schema = df.drop(ids).schema.add(ids, T.ArrayType(T.IntegerType()))

    def encode_batches(batches):
        model = _model(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(text), "").to_pylist()
            found = pa.array([model.encode(t) for t in texts], pa.list_(pa.int32()))
            kept = batch.drop_columns([ids]) if ids in batch.schema.names else batch
            yield pa.RecordBatch.from_arrays([*kept.columns, found], [*kept.schema.names, ids])

    return df.mapInArrow(encode_batches, schema)


def decode(df, path, ids="ids", text="decoded"):
    """Add the decoded text of an id array; a null array stays null."""
    schema = df.drop(text).schema.add(text, "string")

    def decode_batches(batches):
        model = _model(path)
        for batch in batches:
            found = [None if i is None else model.decode(i) for i in batch.column(ids).to_pylist()]
            kept = batch.drop_columns([text]) if text in batch.schema.names else batch
            columns = [*kept.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, text])

    return df.mapInArrow(decode_batches, schema)


@query("op10_rank_array_bpe")
def op10_rank_array_bpe(spark, sf_dir):
    import public_tokenizers

    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return encode_decode_digests(documents, path).drop("text")
