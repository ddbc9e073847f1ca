"""Jaccard join of shingle sets by prefixes under several global token orders.

Tokens are 64-bit numbers of word shingles. Ordering them by different mixings of the
number gives several global orders. Two sets that are similar enough share a token
among the first few of each under *every* order. The first order, which puts frequent
tokens last, finds candidates; they must share several tokens of slightly longer
prefixes. The other orders must agree before a pair is verified on the whole sets.

Sets that are equal are one set from the start. Tokens in the prefixes of very many
sets (a passage that a third of the texts hold) would pair all of them, so sets with
such tokens go another exact way: the token space is cut into more parts than two
similar sets have differences, so at least one part must be the same in both. Sets that
share a part with very many others are compared with a few of them only, then the ones
that are not linked to these go on to a round of more, and the triangle inequality of
the Jaccard distance tells which of the linked ones they can still reach.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gradeloom.llm.catalog import query
from gradeloom.llm.components import components
from gradeloom.llm.filters import filter_of, held, split
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ORDERS = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]
#: Bits of the filter that names frequent tokens.
FREQUENT_BITS = 1 << 25
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHARS = np.random.Generator(np.random.PCG64(42)).integers(0, 2**64, 256, np.uint64)
_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS = {}
#: Bytes of text that are worked on at a time, of one text or of several.
SEGMENT = 1 << 20
#: Heads that a very long list is first compared with, and by how much they grow.
FIRST_HEADS, HEADS_GROW = 2, 4


@dataclass(frozen=True)
class Settings:
    """Similarity as a fraction of whole numbers, so that the bound is exact.

    Lists of up to ``short_list`` sets are paired; longer ones take the other way.
    Prefixes are ``matches - 1`` tokens longer than they need be, so that candidates
    have to share as many tokens as ``matches``, or all that they must share. The order
    of the tokens is mended at most ``rounds`` times.
    """

    words: int = 4
    shared: int = 85
    of: int = 100
    short_list: int = 24
    matches: int = 5
    rounds: int = 6


def _powers(n):
    """Powers of the base and of its inverse; those of a usual segment are kept."""
    if len(_POWERS.get("up", ())) < n:
        made = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if n > 2 * SEGMENT:
            return made[0][:n], made[1][:n]
        _POWERS["up"], _POWERS["down"] = made
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mixed(x):
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _word_hashes(raw, bounds):
    """(hash of each word, number of words before each bound) of joined texts.

    A word ends at white space and at a bound.
    """
    word = ~_WHITE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[bounds] = True
    starts = np.flatnonzero(word & (first[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (first[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CHARS[_LOWER[raw]] * up[:-1], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, bounds)


def _shingles(hashes, words):
    shingles = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        shingles = _mixed(shingles + hashes[i : i + len(shingles)]) + np.uint64(i)
    return shingles


def _whole_sequence(hashes):
    whole = np.uint64(len(hashes))
    for h in hashes:
        whole = _mixed(np.array([whole], np.uint64) + h)[0]
    return np.array([whole], np.uint64)


def _long_set(text, words):
    """The set of a text longer than a segment, which is cut at white space. Each
    segment's shingles begin in the last words of the one before."""
    found, before, start = [], np.zeros(0, np.uint64), 0
    raw = np.frombuffer(text, np.uint8)
    while start < len(raw):
        stop = min(len(raw), start + SEGMENT)
        while stop < len(raw):
            blank = np.flatnonzero(_WHITE[raw[stop : stop + SEGMENT]])
            if len(blank):
                stop += int(blank[0])
                break
            stop = min(len(raw), stop + SEGMENT)  # a word without end
        part = raw[start:stop]
        hashes = np.concatenate([before, _word_hashes(part, np.array([0, len(part)]))[0]])
        if len(hashes) >= words:
            found.append(np.unique(_shingles(hashes, words)))
        before = hashes[max(0, len(hashes) - words + 1) :]
        start = stop
    if found:
        return np.unique(np.concatenate(found))
    return _whole_sequence(before) if len(before) else before


def text_sets(texts, words):
    """Sorted distinct shingle numbers of each text, given as bytes.

    Texts with fewer words than a shingle have their whole sequence as one. Joined texts
    and their arrays are of a segment's size; longer texts are worked on in segments.
    """
    sets = [np.zeros(0, np.uint64)] * len(texts)
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text) > SEGMENT:
            sets[i] = _long_set(text, words)
            continue
        held.append(i)
        size += len(text)
        if size >= SEGMENT:
            _short_sets(texts, held, words, sets)
            held, size = [], 0
    _short_sets(texts, held, words, sets)
    return sets


def _short_sets(texts, places, words, sets):
    bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in places])]).astype(np.int64)
    raw = np.frombuffer(b"".join([texts[i] for i in places]), np.uint8)
    if not len(raw):
        return
    hashes, of_text = _word_hashes(raw, bounds)
    shingles = _shingles(hashes, words)
    for i, lo, hi in zip(places, of_text, of_text[1:]):
        if hi - lo >= words:
            sets[i] = np.unique(shingles[lo : hi - words + 1])
        elif hi > lo:
            sets[i] = _whole_sequence(hashes[lo:hi])


def prefix_length(n, settings):
    """Tokens of which similar sets must share one: all but the least overlap, plus one."""
    return n - -(-settings.shared * n // settings.of) + 1


def similar(x, y, settings):
    """(shared tokens, whether they suffice) of two sorted sets."""
    shared = len(np.intersect1d(x, y, True))
    return shared, settings.of * shared >= settings.shared * (len(x) + len(y) - shared)


def head(tokens, order, settings):
    """The set's first tokens under one of the orders, as ranks.

    A rank is one to one with its token (an odd factor and a shift), so equal ranks
    mean equal tokens. Order 0 is that of the tokens themselves.
    """
    ranks = tokens
    if order:
        ranks = tokens * _ORDERS[order - 1]
        ranks = ranks ^ (ranks >> np.uint64(32))
    k = prefix_length(len(ranks), settings) if len(ranks) else 0
    return ranks if k >= len(ranks) else np.partition(ranks, k - 1)[:k]


def agree(x, y, settings):
    """Whether two sets share a prefix token under every order."""
    return all(
        len(np.intersect1d(head(x, order, settings), head(y, order, settings)))
        for order in range(len(_ORDERS) + 1)
    )


def levels(n, settings):
    """Size level of a set: similar sets are in the same or in neighbouring ones."""
    return int(np.floor(np.log(max(n, 1)) / np.log(settings.of / settings.shared) + 1e-9))


def _differences(level, settings):
    """Most tokens that two similar sets up to the level's size can differ in."""
    largest = int((settings.of / settings.shared) ** (level + 1 + 1e-6)) + 1
    return 2 * largest * (settings.of - settings.shared) // (settings.of + settings.shared)


def part_keys(tokens, settings):
    """Keys of a set for the part filter; similar sets share one of them.

    With more parts than differences, one part is the same in both. Equal empty parts
    say nothing, so a few parts are added; only sets with more empty parts than those
    also give keys for them.
    """
    keys = []
    own = levels(len(tokens), settings)
    for level in (own, own + 1):
        d = _differences(level, settings)
        parts = d + 2 + d // 8
        part = (tokens * _ORDERS[0] >> np.uint64(20)) % np.uint64(parts)
        by_part = np.zeros(parts, np.uint64)
        np.add.at(by_part, part.astype(np.int64), _mixed(tokens * _ORDERS[1]))
        held = np.bincount(part.astype(np.int64), minlength=parts)
        wanted = np.flatnonzero(held) if (held == 0).sum() < parts - d else np.arange(parts)
        salt = np.uint64(level) * np.uint64(1 << 20) + wanted.astype(np.uint64)
        keys.append(_mixed(by_part[wanted] ^ _mixed(salt * _MIX)))
    return np.concatenate(keys)


def _signed(x):
    return x.view(np.int64)


def _lists(arrays, kind):
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_signed(values), kind))


def _of_sets(df, settings, make, schema, size=SEGMENT):
    """Rows that ``make(ids, sets)`` gives for chunks of rows ``(id, text)`` of about
    ``size`` bytes of text."""

    def run(batches):
        for batch in batches:
            at, texts, held = 0, [], 0
            for row, value in enumerate(batch.column(1)):
                texts.append((value.as_py() or "").encode("utf-8", "surrogatepass"))
                held += len(texts[-1])
                if held >= size or row + 1 == batch.num_rows:
                    sets = text_sets(texts, settings.words)
                    texts = []
                    yield make(batch.column(0).slice(at, row + 1 - at), sets)
                    at, held = row + 1, 0

    return df.select("id", "text").mapInArrow(run, schema)


def _signatures(df, settings):
    """id, set size and two numbers that name the set."""

    def sign(ids, sets):
        folded = [[np.bitwise_xor.reduce(_mixed(s * m)) for s in sets] for m in _ORDERS]
        sums = [pa.array(_signed(np.array(f, np.uint64))) for f in folded]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        return pa.RecordBatch.from_arrays([ids, sizes, *sums], ["id", "n", "fa", "fb"])

    return _of_sets(df, settings, sign, "id long, n long, fa long, fb long")


def _frequent(df, settings):
    """Filter of the tokens that stand in more prefixes than a short list holds.

    It is counted on prefixes somewhat longer than needed. Any filter gives a global
    order, so neither what it misses nor what it holds by chance costs a link.
    """

    def count(ids, sets):
        heads = [np.zeros(0, np.uint64)]
        for s in sets:
            if len(s):
                heads.append(s[: (prefix_length(len(s), settings) + settings.matches) * 4 // 3])
        tokens, n = np.unique(np.concatenate(heads), return_counts=True)
        columns = [pa.array(_signed(tokens)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["key", "n"])

    counted = _of_sets(df, settings, count, "key long, n long", 4 * SEGMENT)
    counted = counted.groupBy("key").agg(F.sum("n").alias("n"))
    return filter_of(counted.where(F.col("n") > settings.short_list), "key", FREQUENT_BITS)


def _prefixes(df, frequent, settings):
    """(key, id, n) of the tokens in each set's prefix, frequent tokens last."""

    def cut(ids, sets):
        heads = []
        for s in sets:
            if len(s):
                rare = ~held(frequent, s, FREQUENT_BITS)
                s = np.concatenate([s[rare], s[~rare]])
                s = s[: prefix_length(len(s), settings) + settings.matches - 1]
            heads.append(s)
        sizes = [len(h) for h in heads]
        at = np.repeat(np.arange(len(sets)), sizes)
        columns = [
            pa.array(_signed(np.concatenate(heads))),
            ids.take(pa.array(at)),
            pa.array(np.array([len(s) for s in sets], np.int64)[at]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "id", "n"])

    return _of_sets(df, settings, cut, "key long, id long, n long")


def _ordered_lists(texts, settings):
    """(key, id, n) of the prefix tokens of all sets, with frequent tokens last.

    Which tokens are frequent shows in the lists themselves: a token of a long list joins
    the filter, and the sets that hold one in their prefix are ordered anew, which brings
    other tokens to the front. Sets without one keep their prefix under the new order, so
    only the others are made again. Few rounds are needed, as each moves all long lists at
    once; what is long after them goes the other way.
    """
    spark = texts.sparkSession
    frequent = _frequent(texts, settings)
    first = stage(_prefixes(texts, frequent, settings), "prefixes")
    lists, moved = first, None
    for _ in range(settings.rounds):
        counts = lists.groupBy("key").agg(F.count("*").alias("n"))
        long = filter_of(counts.where(F.col("n") > settings.short_list), "key", FREQUENT_BITS)
        fresh = long & ~frequent
        if not fresh.any():
            break
        frequent = frequent | fresh
        # By the bits of the filter: a token that shares one moves as well.
        bits = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little")).astype(np.int64)
        bits = spark.createDataFrame(pa.table({"bit": bits}))
        crowded = lists.select("id", F.pmod("key", F.lit(FREQUENT_BITS)).alias("bit")).join(bits, "bit", "left_semi")
        crowded = crowded.select("id")
        moved = stage((crowded if moved is None else crowded.union(moved)).distinct(), "reordered")
        _, again = split(texts, moved, "id")
        again = _prefixes(again, frequent, settings).join(moved, "id", "left_semi")
        again = stage(again.select("key", "id", "n"), "reordered-prefixes")
        lists = first.join(moved, "id", "left_anti").select("key", "id", "n").unionByName(again)
    return lists


def _whole_sets(df, ids, settings):
    """(id, set) of the rows whose id is in ``ids``, made anew from the texts.

    A filter of fixed size drops most other rows before the texts are worked on; the
    join drops the rest.
    """

    def whole(found, sets):
        return pa.RecordBatch.from_arrays([found, _lists(sets, pa.int64())], ["id", "tokens"])

    _, wanted = split(df.where("id is not null").select("id", "text"), ids, "id")
    made = _of_sets(wanted, settings, whole, "id long, tokens array<long>")
    return stage(made.join(ids.distinct(), "id", "left_semi").dropDuplicates(["id"]), "sets")


def _short_pairs(lists, settings):
    """Pairs within lists of bounded length, of sets whose sizes allow a link."""
    member = F.struct("id", "n")
    members = lists.groupBy("key").agg(F.sort_array(F.collect_set(member)).alias("ids"))
    first = members.select("ids", F.posexplode("ids").alias("at", "x"))
    rest = first.select("x", F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("y"))
    smaller, larger = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    near = rest.where(settings.of * smaller >= settings.shared * larger)
    return near.select(F.col("x.id").alias("x"), F.col("y.id").alias("y"), (smaller + larger).alias("both"))


def _matched(pairs, settings):
    """Pairs that share as many prefix tokens as linked ones of their sizes must."""
    overlap = F.ceil(F.col("both") * settings.shared / (settings.shared + settings.of) - 1e-9)
    counted = pairs.groupBy("x", "y").agg(F.count("*").alias("tokens"), F.first("both").alias("both"))
    return counted.where(F.col("tokens") >= F.least(F.lit(settings.matches), overlap)).select("x", "y")


def _verify(pairs, sets, settings, check_orders):
    """(x, y, shared, n_x, n_y, linked) of distinct candidate pairs."""
    left = sets.select(F.col("id").alias("x"), F.col("tokens").alias("tx"))
    right = sets.select(F.col("id").alias("y"), F.col("tokens").alias("ty"))
    joined = pairs.select("x", "y").distinct().join(left, "x").join(right, "y")

    def verify_batches(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                x, y = (
                    np.asarray(batch.column(c)[i].values).view(np.uint64) for c in ("tx", "ty")
                )
                if settings.of * min(len(x), len(y)) < settings.shared * max(len(x), len(y)):
                    shared, linked = -1, False
                elif check_orders and not agree(x, y, settings):
                    shared, linked = -1, False
                else:
                    shared, linked = similar(x, y, settings)
                rows.append((shared, len(x), len(y), linked))
            columns = list(zip(*rows)) if rows else [()] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("y"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["x", "y", "shared", "n_x", "n_y", "linked"],
            )

    return joined.mapInArrow(verify_batches, "x long, y long, shared long, n_x long, n_y long, linked boolean")


def _split(lists, settings):
    """(rows of short lists, rows of long ones with their number); lists of one are of no use.

    Most keys stand once. A filter of fixed size over the others drops nearly all rows
    before the join. The counts are written first, so that it is a join of two plain
    tables in which Spark can split a hot key.
    """
    counts = lists.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    counts = stage(counts, "list-sizes")
    _, several = split(lists, counts, "key", bits=1 << 24)
    counted = stage(several.join(counts, "key"), "counted-lists")
    is_short = F.col("rows") <= settings.short_list
    return counted.where(is_short).drop("rows"), counted.where(~is_short)


def _part_links(sets, settings):
    """Links among the given sets by shared parts, enough for their components.

    A long list is compared with heads drawn from it. Members that are linked to one
    belong to it, the others go on to a round of more heads. So the rounds are about the
    logarithm of a list's length, and a list of which nothing is linked makes at most a
    few times its pairs. The draw is by the number of an id; with as many heads as
    members all are heads, so the rounds end.
    """

    def key_batches(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = np.asarray(batch.column("tokens")[i].values).view(np.uint64)
                keys = _signed(part_keys(tokens, settings))
                ids = np.full(len(keys), batch.column("id")[i].as_py(), np.int64)
                sizes = np.full(len(keys), len(tokens), np.int64)
                columns = [pa.array(c) for c in (keys, ids, sizes)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "id", "n"])

    lists = stage(sets.mapInArrow(key_batches, "key long, id long, n long"), "parts")
    found, heads = None, FIRST_HEADS
    while True:
        short, long = _split(lists, settings)
        linked = _verify(_short_pairs(short, settings), sets, settings, False).where("linked").select("x", "y")
        if long.isEmpty():
            links = linked if found is None else found.unionByName(linked)
            return stage(links, "part-links")
        # About as many heads of each list, the same ones in lists that share members.
        drawn = F.pmod(F.xxhash64("id", F.lit(heads)), F.lit(1 << 30)) * F.col("rows") < F.lit(heads << 30)
        members = stage(long.select("key", "id", "n", drawn.alias("head")), "members")
        # How far each member is from the heads of its list.
        stars = members.select("key", F.col("id").alias("y"), "head").join(
            members.where("head").select("key", F.col("id").alias("x")), "key"
        )
        stars = stars.where("x < y or x > y and not head")
        pair = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
        judged = stage(_distances(stars.select(*pair).distinct(), sets, settings), "stars")
        both = judged.union(judged.select("y", "x", "distance", "linked"))
        placed = stage(stars.where("not head").join(both, ["x", "y"]).select("key", *both.columns), "placed")
        # A member that is linked to heads belongs to the nearest of them.
        near = placed.where("linked").groupBy("key", F.col("y").alias("a"))
        near = near.agg(F.min(F.struct("distance", "x")).alias("of"))
        near = stage(near.select("key", "a", "of.x", F.col("of.distance").alias("da")), "near")
        # Not linked to a head, yet near enough to reach one that belongs to it.
        reach = 1 - settings.shared / settings.of
        outer = placed.where(~F.col("linked") & (F.col("distance") <= 2 * reach + 1e-9))
        across = (
            outer.select("key", "x", F.col("y").alias("b"), F.col("distance").alias("db"))
            .join(near, ["key", "x"])
            .where(F.col("da") >= F.col("db") - reach - 1e-9)
            .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        )
        crossed = _verify(across, sets, settings, False).where("linked").select("x", "y")
        now = judged.where("linked").select("x", "y").unionByName(linked).unionByName(crossed)
        found = stage(now if found is None else found.unionByName(now), "part-links")
        settled = near.select("key", F.col("a").alias("id"))
        lists = members.where("not head").join(settled, ["key", "id"], "left_anti").select("key", "id", "n")
        lists = stage(lists, "parts")
        heads *= HEADS_GROW


def _distances(pairs, sets, settings):
    left = sets.select(F.col("id").alias("x"), F.col("tokens").alias("tx"))
    right = sets.select(F.col("id").alias("y"), F.col("tokens").alias("ty"))
    joined = pairs.join(left, "x").join(right, "y")
    shared = F.size(F.array_intersect("tx", "ty")).cast("long")
    union = F.size("tx") + F.size("ty") - shared
    return joined.select(
        "x", "y", (1 - shared / union).alias("distance"), (settings.of * shared >= settings.shared * union).alias("linked")
    )


def similarity_links(df, settings=Settings()):
    """(signatures, links): one row per input row, and pairs of linked set heads.

    ``df`` has ``id`` and ``text``. The smallest id of the rows with one set stands for
    it. No link between different sets is lost, whatever the length of a list.
    """
    signed = stage(_signatures(df.select("id", "text"), settings), "signatures")
    heads = (
        signed.where("n > 0 and id is not null")
        .groupBy("n", "fa", "fb")
        .agg(F.min("id").alias("head"))
    )
    heads = stage(heads, "heads")
    texts = df.select("id", "text").where("id is not null")
    _, headed = split(texts, heads.select(F.col("head").alias("id")), "id")
    # The filter lets a few copies of a head through; their sets add nothing new.
    short, long = _split(_ordered_lists(headed, settings), settings)
    # Two sets that share a token of a long list go the other way.
    candidates = stage(_matched(_short_pairs(short, settings), settings), "candidates")
    crowded = stage(long.select("id").distinct(), "crowded")
    wanted = candidates.select(F.col("x").alias("id")).union(candidates.select("y")).union(crowded)
    sets = _whole_sets(df.select("id", "text"), stage(wanted.distinct(), "wanted"), settings)
    links = _verify(candidates, sets, settings, True).where("linked").select("x", "y")
    links = stage(links, "links")
    if not crowded.isEmpty():
        links = links.unionByName(_part_links(sets.join(crowded, "id", "left_semi"), settings))
        links = stage(links.distinct(), "links")
    return signed.select("id", "n", "fa", "fb"), heads, links


def near_duplicates(df, settings=Settings(), key="doc_id", text="text"):
    """One row per row of ``df``: ``key``, ``n_shingles``, ``component_id``.

    A null or wordless text has no shingles and is its own component. Repeated rows are
    repeated. A row with a null key is linked with nothing and has no component.
    """
    ids = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed, heads, links = similarity_links(ids, settings)
    found = components(links)
    named = heads.join(found, heads["head"] == found["node"], "left").select(
        "n", "fa", "fb", F.coalesce("component", "head").alias("component_id")
    )
    joined = signed.join(named, ["n", "fa", "fb"], "left")
    own = (F.col("n") == 0) | F.col("id").isNull()
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(own, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


@query("op4_multi_order_join")
def op4_multi_order_join(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
