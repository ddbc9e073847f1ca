import hashlib
import itertools
import random
import re
import zlib
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from gradeloom.llm import conversation_repair as cr

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def least(rows):
    """(cost, audit, turns) by a search over all edits in order of cost, then audit.

    ``rows``: [(role, text, must go, truncated)].
    """
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, roles, turns = heappop(heap)
        state = roles[-1:]
        if at == len(rows) and state in ("", "a"):
            return cost, audit, turns
        if (at, state, roles == "") in done:
            continue
        done.add((at, state, roles == ""))
        follow = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[follow]
        heappush(heap, (cost + 2, audit + "I", at, roles + follow, turns + ((name, ""),)))
        if at < len(rows):
            role, text, must_go, truncated = rows[at]
            heappush(heap, (cost + 3, audit + "D", at + 1, roles, turns))
            if not must_go:
                extra = int(truncated)
                heappush(heap, (cost + 2 + extra, audit + "R", at + 1, roles + follow, turns + ((name, text),)))
                fits = role[:1] == follow or (role[:1] == "s" and not roles)
                if fits:
                    heappush(heap, (cost + extra, audit + "K", at + 1, roles + role[0], turns + ((role, text),)))
    raise AssertionError


def brute(rows):
    """Expected rows of the query from all (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        kept = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {conv: expected(kept) for conv, kept in groups.items()}


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    blank = duplicate = truncated = 0
    seen, marked = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        go = cut = False
        if not solid:
            blank, go = blank + 1, True
        elif (role, text) in seen:
            duplicate, go = duplicate + 1, True
        elif solid[-1] not in ".!?":
            truncated, cut = truncated + 1, True
        seen.add((role, text))
        marked.append((role, text, go, cut))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, fixed = least(marked)
    lines = "\n".join(f"{role}:{text}" for role, text in fixed)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["a.", "b", "c!", "", " \t", "d? ", "é", "same.", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, 0]), role, text))
    rows += [(None, 1, "user", "x"), (None, 2, "user", "x")]
    return rows


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(cr.op12_conversation_repair(spark, SF)) == brute(rows)


@pytest.mark.parametrize("settings", [cr.Settings(), cr.Settings(long_rows=3), cr.Settings(long_rows=1, long_bytes=1)])
def test_random_conversations_whole_and_in_slices(spark, settings):
    rows = random_rows(7, 150, 14)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(cr.repair_report(cr.damage(df), settings)) == brute(rows)


def test_cheapest_edits_of_all_short_kinds():
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    for size in range(1, 4):
        for kinds in itertools.product("suaxSUAXd", repeat=size):
            rows = [(names[k.lower()], "t", k == "d", k.isupper()) for k in kinds]
            cost, audit, _ = least(rows)
            got, edits, tail = cr.cheapest_edits("".join(kinds))
            assert (got, "".join(edits) + tail) == (cost, audit), kinds


@pytest.mark.parametrize("long_rows", [10_000, 2])
def test_repaired_turns(spark, long_rows):
    rows = random_rows(3, 40, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    settings = cr.Settings(long_rows=long_rows)
    turns = {}
    for r in sorted(cr.repaired_turns(df, settings).collect(), key=lambda r: (str(r.conv_id), r.place)):
        assert r.place == len(turns.setdefault(r.conv_id, [])) + 1
        turns[r.conv_id].append((r.role, r.text, r.edit))
    for r in cr.repair_report(df, settings).collect():
        own = turns.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _, _ in own))
        assert cr.digest(own) == r.repaired_sha256
        assert "".join(e for _, _, e in own) == r.audit.replace("D", "")


def test_odd_rows(spark):
    long_text = "word " * 400_000
    rows = [(1, 0, "user", long_text + "."), (1, 1, "assistant", "Yes."), (2, 0, "user", None), (3, None, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("mine")).withColumn("fault", F.lit(1))
    for settings in (cr.Settings(), cr.Settings(long_bytes=100_000)):
        reports = {r.conv_id: r for r in cr.repair_report(df, settings).collect()}
        assert (reports[1].audit, reports[1].cost) == ("KK", 0)
        assert (reports[2].audit, reports[2].blank) == ("D", 1)
        assert reports[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
        assert reports[3].gaps == 0
    assert cr.repair_report(df.limit(0)).collect() == []
    gone = df.withColumn("times", F.lit(0))
    for settings in (cr.Settings(), cr.Settings(long_rows=1)):
        got = found(cr.repair_report(gone, settings))
        assert set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_one_conversation_with_a_third_of_the_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat_ws(" ", F.lit("Row"), F.col("id") % 700, F.lit(".")).alias("text"),
    )
    settings = cr.Settings(long_rows=64)
    got = cr.repair_report(rows, settings).where("conv_id = 0").first()
    assert tuple(got)[1:] == expected([(r.turn, r.role, r.text) for r in rows.where("conv_id = 0").collect()])
