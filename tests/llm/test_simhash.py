import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gradeloom.llm import simhash as sh

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text, settings=sh.Settings()):
    """The same votes, one term and one bit at a time."""
    mask = (1 << 64) - 1

    def mixed(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return x ^ x >> 31

    def hashed(word):
        return sh.xxhash.xxh64_intdigest(word.encode())

    words = text.lower().split()
    terms = []
    for size in range(1, settings.longest + 1):
        found = Counter()
        for i in range(len(words) - size + 1):
            x = size
            for word in words[i : i + size]:
                x = (x * 0x100000001B3 + hashed(word)) & mask
            found[mixed(x)] += 1
        terms += [(term, size * n.bit_length()) for term, n in found.items()]
    if len(text) < settings.short and words:
        line = " ".join(words)
        runs = Counter(line[i : i + 4] for i in range(max(1, len(line) - 3)))
        terms += [(~hashed(run) & mask, n.bit_length()) for run, n in runs.items()]
    votes = [0] * settings.bits
    for term, weight in terms:
        for lane in range(settings.bits // 64):
            value = mixed((term + lane * 0x9E3779B97F4A7C15) & mask).to_bytes(8, "little")
            for i, byte in enumerate(value):
                for bit in range(8):
                    votes[64 * lane + 8 * i + bit] += weight if byte >> (7 - bit) & 1 else -weight
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):0{settings.bits // 4}x}"


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, mark, other = map(plain_fingerprint, (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[key] = (len(text), sha, own, mark, 1 - distance(own, mark) / 128, 1 - distance(own, other) / 128)
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    some = expected([r for r in rows if len(r[1] or "") < 4000][:150])  # the plain form is slow
    small = spark.createDataFrame([r for r in rows if r[0] in some], "doc_id long, text string").repartition(4)
    assert {r.doc_id: tuple(r)[1:] for r in sh.against_edited(small).collect()} == some
    found = {r.doc_id: r for r in sh.op11_simhash(spark, SF).collect()}
    assert len(found) == len(rows)
    prints = {key: sh.fingerprint(text or "") for key, text in rows}
    for key, r in found.items():
        assert r.fingerprint == prints[key]
        near = sum(distance(prints[key], p) <= 6 for p in prints.values()) - 1
        assert r.n_near == (near if key % 100 == 0 else None)
    ordered = sorted(rows)
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = sh._edited(text or "", following or "")
        assert found[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[key].edited_fingerprint == sh.fingerprint(edited)
    better = [r.near_edited > r.near_next for r in found.values()]
    assert sum(better) / len(better) > 0.97


@pytest.mark.parametrize("bits, radius, least", [(64, 3, 1), (128, 6, 1), (128, 9, 40_000_000)])
def test_search_finds_every_pair_once(spark, monkeypatch, bits, radius, least):
    """Fingerprints crowd around a few centres; more rows only change the tables."""
    rng = random.Random(bits + radius)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(bits)
        for _ in range(40):
            flipped = sum(1 << i for i in rng.sample(range(bits), rng.randrange(0, radius + 1)))
            prints.add(f"{centre ^ flipped:0{bits // 4}x}")
    tables = sh.block_tables
    monkeypatch.setattr(sh, "block_tables", lambda d, r, n: tables(d, r, max(n, least)))
    all_prints = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    asked = all_prints.where(F.xxhash64("fingerprint") % 5 == 0)
    found = [tuple(r) for r in sh.search(all_prints, asked, sh.Settings(bits=bits, radius=radius)).collect()]
    pairs = [
        (q.fingerprint, p, distance(q.fingerprint, p))
        for q in asked.collect() for p in prints
        if q.fingerprint != p and distance(q.fingerprint, p) <= radius
    ]
    assert sorted(found) == sorted(pairs) and len(pairs) > 300


def test_near_rows_are_counted_with_their_copies(spark):
    near = "0" * 31 + "1"
    rows = [("0" * 32,)] * 5 + [(near,)] * 3 + [("f" * 32,)] * 2
    rows = spark.createDataFrame(rows, "fingerprint string")
    got = {r.fingerprint: r.n_near for r in sh.count_near(rows, rows).collect()}
    assert got == {"0" * 32: 7, near: 7, "f" * 32: 1}


def test_segments_and_long_words(monkeypatch):
    text = "one two three four five six seven " * 3 + "x" * 100 + " end"
    settings = sh.Settings(short=0)
    assert sh.fingerprint(text, settings) == plain_fingerprint(text, settings)
    monkeypatch.setattr(sh, "SEGMENT", 20)
    cut = sh.fingerprint(text, settings)
    assert cut == sh.fingerprint(text, settings) and sh.likeness(cut, plain_fingerprint(text, settings)) > 0.7
    words = [w for part in sh._segments(text) for w in part]
    assert "".join(words) == text.replace(" ", "") and max(map(len, words)) <= 40


def test_one_word_more_is_near():
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    own = sh.fingerprint(" ".join(words))
    words[200] = "other"
    assert distance(own, sh.fingerprint(" ".join(words))) <= 16
    other = sh.fingerprint(" ".join(f"w{rng.randrange(5000)}" for _ in range(400)))
    assert distance(own, other) > 40


def test_odd_rows(spark):
    long = "long text " * 300_000
    rows = [(1, None, "a"), (2, "", "b"), (None, "no id", "c"), (4, long, "d"), (5, "same", "e"), (5, "same", "f"), (6, " \n", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").withColumn("n_chars", F.lit("x"))
    got = sh.against_edited(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].n_chars == 0 and by[1].fingerprint == "0" * 32 and by[1].near_edited == 1.0
    assert by[4].edited_sha256 == hashlib.sha256((long[: len(long) // 2] + "same").encode()).hexdigest()
    assert by[6].edited_sha256 == hashlib.sha256(b" n").hexdigest()  # the first row comes after the last
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    assert sh.against_edited(df.limit(0)).collect() == []
    one = sh.against_edited(df.where("doc_id = 4")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256((long[: len(long) // 2] * 2).encode()).hexdigest()
    added = sh.add_fingerprints(df)
    assert added.columns == ["doc_id", "text", "n_chars", "fingerprint"]
    assert {len(r.fingerprint) for r in added.collect()} == {32}
