"""Cheapest repair of conversations, by Hirschberg's divide and conquer.

Rows are kept, given another role, deleted, or led in by an empty turn, so that the roles
read: perhaps a system turn, then user and assistant in turns. Where a conversation
stands is one of four states, so all that a stretch of rows needs to tell about its past
is a vector of four costs. A forward and a backward vector meet in the middle, the best
crossing state splits the task in two, and each half is solved alone: no table of
choices is kept.

Of equally cheap repairs the one with the least audit (the initials of its edits) wins.
Audits of two states after the same rows differ before either ends, so a rank of the
states beside their costs settles every tie without comparing audits.

A conversation is repaired where its rows meet, unless it is long. A long one is cut into
slices: each slice sums up as a table of costs from state to state, the same method over
these tables finds the states between the slices, and then every slice is solved alone.
"""

import hashlib
import re
from collections import namedtuple
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.operators.ordering import number_rows
from gradeloom.sources.staging import stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: The state after a turn put in or given another role.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Turns put in at the end of a conversation.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}
BLANK = " \t\n\x0b\x0c\r"
CACHED_KINDS = 100_000
_BEFORE_OPS = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,), "x": ()}
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


@dataclass(frozen=True)
class Settings:
    """Conversations over ``long_rows`` rows or ``long_bytes`` bytes of text are cut into
    slices of ``long_rows`` rows. The result does not depend on it."""

    long_rows: int = 10_000
    long_bytes: int = 1 << 24


Report = namedtuple("Report", "gaps blank duplicate truncated illegal cost audit")


def _moves(kind):
    """For each state: [(state after the row, cost, edits)] of a row of some kind.

    A kind is the class of the role (``s u a``, ``x`` for any other), in upper case if
    the text is truncated, or ``d`` for a row that has to go.
    """
    table = []
    for state in STATES:
        best = {state: (DELETE, "D")}
        if kind != "d":
            extra = TRUNCATED if kind.isupper() else 0
            for lead, at in (("", state), ("I", NEXT[state])):
                cost = extra + INSERT * len(lead)
                found = [(NEXT[at], cost + REROLE, lead + "R")]
                if at in _BEFORE_OPS[kind.lower()]:
                    found.append((_AFTER[kind.lower()], cost, lead + "K"))
                for after, total, edits in found:
                    best[after] = min(best.get(after, (total, edits)), (total, edits))
        table.append([(after, *rest) for after, rest in best.items()])
    return table


MOVES = {kind: _moves(kind) for kind in "suaxSUAXd"}
_FAR = float("inf")


def forward(tables, start):
    """Cost of each state after the given rows (or slices), and the rank of its audit."""
    costs, ranks = [_FAR] * 4, [0] * 4
    costs[start] = 0
    for table in tables:
        best = {}
        for state in STATES:
            if costs[state] < _FAR:
                for after, cost, label in table[state]:
                    found = (costs[state] + cost, ranks[state], label)
                    if after not in best or found < best[after]:
                        best[after] = found
        costs, ranks = [_FAR] * 4, [0] * 4
        for rank, state in enumerate(sorted(best, key=lambda s: best[s][1:])):
            costs[state], ranks[state] = best[state][0], rank
    return costs, ranks


def backward(tables, end):
    """Cost from each state before the given rows (or slices) to the end state."""
    costs = [_FAR] * 4
    costs[end] = 0
    for table in reversed(tables):
        costs = [
            min((cost + costs[after] for after, cost, _ in table[state]), default=_FAR)
            for state in STATES
        ]
    return costs


def crossings(tables, start, end):
    """States after each row (or slice) of the cheapest, audit-least way."""
    if len(tables) <= 1:
        return [end] * len(tables)
    middle = len(tables) // 2
    left, right = tables[:middle], tables[middle:]
    costs, ranks = forward(left, start)
    rest = backward(right, end)
    state = min(STATES, key=lambda s: (costs[s] + rest[s], ranks[s]))
    return crossings(left, start, state) + crossings(right, state, end)


def best_end(costs, ranks):
    """(state after the last row, whole cost) with the turns put in at the end."""
    state = min(STATES, key=lambda s: (costs[s] + INSERT * len(TAIL[s]), ranks[s]))
    return state, costs[state] + INSERT * len(TAIL[state])


def edits_between(kinds, start, end):
    """Edits of each row of a stretch from one state to another."""
    tables = [MOVES[kind] for kind in kinds]
    edits = []
    for table, after in zip(tables, crossings(tables, start, end)):
        edits.append(min((cost, label) for to, cost, label in table[start] if to == after)[1])
        start = after
    return edits


def cheapest_edits(kinds):
    """(cost, edits of each row, turns put in at the end)."""
    end, cost = best_end(*forward([MOVES[kind] for kind in kinds], START))
    return cost, edits_between(kinds, START, end), TAIL[end]


def apply_edits(rows, state=START):
    """Turns (role, text, edit) of (role, text, edits) rows; yields the state at last.

    Rows may be a stream. Every edit but a kept row follows from the state.
    """
    for role, text, edits in rows:
        for edit in edits:
            if edit == "K":
                state = _AFTER[role[0]]
                yield role, text, edit
            elif edit != "D":
                state = NEXT[state]
                yield NAMES[state], text if edit == "R" else "", edit


def illegal_pairs(classes):
    return sum(a + b not in LEGAL for a, b in zip(classes, classes[1:]))


def _role_class(role):
    return role[0] if role[:1] in _AFTER else "x"


_CHEAPEST = {}


def _cached_edits(kinds):
    found = _CHEAPEST.get(kinds)
    if found is None:
        if len(_CHEAPEST) >= CACHED_KINDS:
            _CHEAPEST.clear()
        found = _CHEAPEST[kinds] = cheapest_edits(kinds)
    return found


def repair_conversation(rows):
    """(report, repaired turns) of [(turn, role, text, fault)] in order."""
    seen, kinds, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text, fault in rows:
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kind = _role_class(role)
        kinds.append("d" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
    cost, edits, tail = _cached_edits("".join(kinds))
    turns = {turn for turn, *_ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = illegal_pairs([_role_class(role) for _, role, _, _ in rows])
    edited = [(role, text, e) for (_, role, text, _), e in zip(rows, edits)]
    turns_left = list(apply_edits([*edited, ("", "", tail)]))
    audit = "".join(edits) + tail
    return Report(gaps, **counts, illegal=illegal, cost=cost, audit=audit), turns_left


def digest(turns):
    """sha256 of the turns as lines of role and text."""
    state, parted = hashlib.sha256(), b""
    for role, text, _ in turns:
        state.update(parted + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        parted = b"\n"
    return state.hexdigest()


def with_faults(df, conv="conv_id"):
    """Rows to repair: nulls in role and text are one space, ``fault`` is blank, truncated
    or empty, ``times`` says how often the row stands there (a row with 0 only names its
    conversation)."""
    times = F.col("times") if "times" in df.columns else F.lit(1)
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(times > 0, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(times > 0, F.coalesce("text", F.lit(" "))).alias("text"),
        times.cast("int").alias("times"),
    )
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANK)), -1, 1)
    fault = F.when(end == "", "blank").when(end.isin(".", "!", "?"), "").otherwise("truncated")
    return rows.withColumn("fault", fault)


_REPORT_TYPES = [(n, "long") for n in Report._fields[:-1]] + [("audit", "string")]
_TURN_TYPES = [("place", "long"), ("role", "string"), ("text", "string"), ("edit", "string")]


def _schema(rows, types):
    schema = T.StructType([rows.schema["conv_id"]])
    for name, kind in types:
        schema = schema.add(name, kind)
    return schema


def _arrow(schema, rows, key_type):
    types = [key_type] + [pa.int64() if f.dataType == T.LongType() else pa.string() for f in schema.fields[1:]]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)


def _by_conversation(batches, names):
    """(batch number, key type, key, rows) of a stream sorted by conversation."""
    key, rows, kind = None, None, None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for value, *row in zip(*(batch.column(n).to_pylist() for n in ["conv_id", *names])):
            if rows is None or value != key:
                if rows is not None:
                    yield kind, key, rows
                key, rows = value, []
            rows.append(row)
    if rows is not None:
        yield kind, key, rows


def _short(rows, schema, made, size=1000):
    """What ``made`` gives for each conversation, a stage sorted by conversation."""

    def run(batches):
        out, kind = [], pa.int64()
        found = _by_conversation(batches, ["turn", "role", "text", "fault", "times"])
        for kind, key, group in found:
            held = [tuple(row[:4]) for row in group for _ in range(row[4])]
            out += [(key, *row) for row in made(*repair_conversation(held))]
            if len(out) >= size:
                yield _arrow(schema, out, kind)
                out = []
        yield _arrow(schema, out, kind)

    order = [F.asc_nulls_first("turn"), F.asc("role"), F.md5(F.col("text").cast("binary"))]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


def _conv(left, right):
    return F.col(left).eqNullSafe(F.col(right))


class _Long:
    """The long conversations: numbered rows, slices, states between the slices."""

    def __init__(self, rows, settings):
        self.size = settings.long_rows
        rows = rows.where("times > 0").withColumn("_text", F.md5(F.col("text").cast("binary")))
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "_copy")
        order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("_text")]
        numbered = number_rows(rows, order, "place", within=["conv_id"])
        self.rows = stage(numbered.withColumn("place", F.col("place").cast("long")), "long-rows")
        named = ["conv_id", "role", "_text"]
        first = self.rows.groupBy(*named).agg(F.min("place").alias("_first"))
        # Written out, so that a text on very many rows can be split in the join.
        first = stage(first, "long-first").toDF("_conv", "_role", "_name", "_first")
        same = _conv("conv_id", "_conv") & (F.col("role") == F.col("_role")) & (F.col("_text") == F.col("_name"))
        initial = F.substring("role", 1, 1)
        kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
        repeated = (F.col("place") > F.col("_first")) & (F.col("fault") != "blank")
        fault = F.when(repeated, "duplicate").otherwise(F.col("fault"))
        coded = self.rows.drop("text").join(first, same).withColumn("fault", fault).withColumn("_class", kind)
        kind = F.when(F.col("fault").isin("blank", "duplicate"), "d")
        kind = kind.when(F.col("fault") == "truncated", F.upper("_class")).otherwise(F.col("_class"))
        slice_of = F.floor((F.col("place") - 1) / F.lit(self.size)).alias("slice")
        coded = coded.select("conv_id", "turn", "fault", slice_of, F.struct("place", kind.alias("kind"), "_class").alias("_row"))
        letters = F.sort_array(F.collect_list("_row"))

        def joined(name):
            return F.array_join(F.transform("_rows", lambda r: r[name]), "")

        counts = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
        # At most one slice's rows, as letters, come together.
        slices = coded.groupBy("conv_id", "slice").agg(letters.alias("_rows"), *counts)
        slices = slices.withColumns({"kinds": joined("kind"), "classes": joined("_class")}).drop("_rows")
        self.slices = stage(slices, "long-slices")

    def states(self):
        """(conv_id, slice, start, end, cost, illegal): one group per conversation holds a
        row of fixed size for each of its slices."""
        key = self.slices.schema["conv_id"]
        summed = T.StructType([key]).add("slice", "long").add("table", "string").add("illegal", "long").add("ends", "string")

        def sum_up(batches):
            for batch in batches:
                tables, illegal, ends = [], [], []
                for kinds, classes in zip(batch.column("kinds").to_pylist(), batch.column("classes").to_pylist()):
                    moves = [MOVES[k] for k in kinds]
                    tables.append(";".join(_spell(*forward(moves, s)) for s in STATES))
                    illegal.append(illegal_pairs(classes))
                    ends.append(classes[0] + classes[-1])
                columns = [batch.column("conv_id"), batch.column("slice"), pa.array(tables, pa.string())]
                columns += [pa.array(illegal, pa.int64()), pa.array(ends, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, summed.names)

        found = T.StructType([key]).add("slice", "long").add("start", "long").add("end", "long")
        found = found.add("cost", "long").add("illegal", "long")

        def cross(group):
            group = group.sort_values("slice")
            tables = [[_read(part) for part in table.split(";")] for table in group["table"]]
            end, cost = best_end(*forward(tables, START))
            after = crossings(tables, START, end)
            ends = group["ends"].tolist()
            borders = sum(a[1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:]))
            illegal = int(group["illegal"].sum()) + borders
            return pd.DataFrame(
                {"conv_id": group["conv_id"], "slice": group["slice"], "start": [START, *after[:-1]],
                 "end": after, "cost": cost, "illegal": illegal}
            )

        tables = self.slices.select("conv_id", "slice", "kinds", "classes").mapInArrow(sum_up, summed)
        return stage(tables.groupBy("conv_id").applyInPandas(cross, found), "long-states")

    def edits(self, states):
        """(conv_id, slice, edits of each row), the last slice with the turns at the end."""
        own = states.select(F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"), "start", "end")
        last = states.groupBy("conv_id").agg(F.max("slice")).toDF("_last_conv", "_last")
        joined = self.slices.select("conv_id", "slice", "kinds").join(
            own, _conv("conv_id", "_conv") & (F.col("slice") == F.col("_slice"))
        )
        joined = joined.join(last, _conv("conv_id", "_last_conv"))
        schema = T.StructType([self.slices.schema["conv_id"]]).add("slice", "long").add("edits", T.ArrayType(T.StringType()))

        def solve(batches):
            for batch in batches:
                edits = []
                names = ("kinds", "start", "end", "slice", "_last")
                for kinds, start, end, at, last_slice in zip(*(batch.column(n).to_pylist() for n in names)):
                    found = edits_between(kinds, start, end)
                    if at == last_slice:
                        found[-1] += TAIL[end]
                    edits.append(found)
                columns = [batch.column("conv_id"), batch.column("slice"), pa.array(edits, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return stage(joined.mapInArrow(solve, schema), "long-edits")

    def streamed(self, edits, schema, made):
        """What ``made`` gives for the turns of each conversation. Texts and edits meet
        sorted and are read as a stream, so no conversation is held."""
        asked = edits.select("conv_id", "slice", F.posexplode("edits").alias("_at", "edits"))
        place = F.col("slice") * F.lit(self.size) + F.col("_at") + 1
        nothing = F.lit(None).cast("string")
        asked = asked.select("conv_id", place.alias("place"), "edits", nothing.alias("role"), nothing.alias("text"))
        texts = self.rows.select("conv_id", "place", nothing.alias("edits"), "role", "text")
        both = asked.union(texts).repartition("conv_id")
        both = both.sortWithinPartitions("conv_id", "place", F.asc_nulls_last("edits"))

        def run(batches):
            yield from made(batches, schema)

        return both.mapInArrow(run, schema)

    def report(self):
        """Counts, audit and digest of every long conversation."""
        states = self.states()
        edits = self.edits(states)
        piece = F.struct("slice", F.array_join("edits", "").alias("edits"))
        audit = edits.groupBy("conv_id").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["edits"]), "").alias("audit")
        )
        digests = self.streamed(edits, _schema(self.rows, [("repaired_sha256", "string")]), _digests)
        turns = self.rows.groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
        )
        sums = self.slices.groupBy("conv_id").agg(*[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")])
        costs = states.groupBy("conv_id").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"))
        return [turns, sums, costs, audit, digests]


def _spell(costs, ranks):
    return ",".join(f"{s}:{int(costs[s])}:{ranks[s]}" for s in STATES if costs[s] < _FAR)


def _read(part):
    return [tuple(map(int, move.split(":"))) for move in part.split(",") if move]


def _rows_with_edits(batches):
    """(key type, key, role, text, edits) from a stream of edits, each before its row."""
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "edits", "role", "text"))):
            yield kind, *row


def _changes(batches):
    """(key type, key, whether it is new, turn) for each turn of the repaired stream."""
    key, fresh, state, edits = None, True, START, None
    begun = False
    for kind, value, asked, role, text in _rows_with_edits(batches):
        if not begun or value != key:
            key, state, fresh, begun = value, START, True, True
        if asked is not None:
            edits = asked
            continue
        for turn in apply_edits([(role, text, edits)], state):
            yield kind, key, fresh, turn
            fresh, state = False, _AFTER[turn[0][0]]
        if fresh:  # nothing is left of the conversation so far, but it stands there
            yield kind, key, True, None
            fresh = False


def _digests(batches, schema):
    """One digest per conversation."""
    out, kind, key, state, parted = [], pa.int64(), None, None, b""
    for kind, value, fresh, turn in _changes(batches):
        if fresh:
            if state is not None:
                out.append((key, state.hexdigest()))
            key, state, parted = value, hashlib.sha256(), b""
        if turn is not None:
            state.update(parted + f"{turn[0]}:{turn[1]}".encode("utf-8", "surrogatepass"))
            parted = b"\n"
    if state is not None:
        out.append((key, state.hexdigest()))
    yield _arrow(schema, out, kind)


def _turns(batches, schema, size=1000):
    """Every repaired turn with its place."""
    out, kind, place = [], pa.int64(), 0
    for kind, key, fresh, turn in _changes(batches):
        place = 0 if fresh else place
        if turn is not None:
            place += 1
            out.append((key, place, *turn))
        if len(out) >= size:
            yield _arrow(schema, out, kind)
            out = []
    yield _arrow(schema, out, kind)


def _parted(rows, settings):
    """(short conversations' rows, long conversations' rows or None, their names)."""
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = sizes.where((F.col("n") > settings.long_rows) | (F.col("bytes") > settings.long_bytes))
    long = stage(long.select("conv_id"), "long-conversations")
    if long.isEmpty():
        return rows, None, long
    named = long.toDF("_conv")
    same = _conv("conv_id", "_conv")
    return rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi"), long


def repair_report(df, settings=Settings(), conv="conv_id"):
    """One row per conversation: its faults, the cost and audit of its cheapest repair and
    a sha256 of the repaired turns (``role:text`` lines).

    ``df`` has the conversation, ``turn``, ``role`` and ``text``, and may have ``times``;
    other columns are left out. Rows stand by turn, null turns first, rows of one turn by
    role and a hash of the text. Nulls in role and text are one space, and null
    conversations are one. Without rows there is no row; a conversation whose rows all
    stand there 0 times has zeros, an empty audit and the hash of nothing.
    """
    rows = with_faults(df, conv)
    short, long, names = _parted(rows, settings)
    schema = _schema(rows, [*_REPORT_TYPES, ("repaired_sha256", "string")])
    found = _short(short, schema, lambda report, turns: [(*report, digest(turns))])
    if long is None:
        return found
    parts = names
    for part in _Long(long, settings).report():
        part = part.withColumnRenamed("conv_id", "_conv")
        parts = parts.join(part, _conv("conv_id", "_conv"), "left").drop("_conv")
    zeros = [F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in Report._fields[:-1]]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    sha = F.coalesce("repaired_sha256", F.lit(digest([]))).alias("repaired_sha256")
    return found.unionByName(parts.select("conv_id", *zeros, audit, sha))


def repaired_turns(df, settings=Settings(), conv="conv_id"):
    """The repaired conversations, one row per turn: ``(conv_id, place, role, text, edit)``.

    ``place`` counts from 1, ``edit`` is K for a kept row, R for one with another role, I
    for an empty turn put in. Input and odd rows as in :func:`repair_report`.
    """
    rows = with_faults(df, conv)
    short, long, _ = _parted(rows, settings)
    schema = _schema(rows, _TURN_TYPES)
    found = _short(short, schema, lambda _, turns: [(i, *turn) for i, turn in enumerate(turns, 1)])
    if long is None:
        return found
    parts = _Long(long, settings)
    return found.unionByName(parts.streamed(parts.edits(parts.states()), schema, _turns))


def damage(conversations):
    """Damaged rows, by a checksum of conversation and turn: dropped (0 times), emptied,
    without sentence ends, doubled, or by a user."""

    def spelled(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(spelled("conv_id"), F.lit(":"), spelled("turn"))
    rows = conversations.withColumn("_fault", F.crc32(key.cast("binary")) % 20)
    fault, text = F.col("_fault"), spelled("text")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    role = F.when(fault == 4, "user").otherwise(spelled("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, sf_dir):
    return repair_report(damage(read(spark, sf_dir, "conversations")))
