"""Repair of conversations by a dynamic program over their turns, streamed in order.

Rows are partitioned by conversation and sorted by turn; each task reads its rows as one
stream. What is carried from row to row, also across Arrow batches, is a cost, a rank and a
running hash for each state of the wanted form ``(s?(ua)+)?``: nothing written, after the
system turn, after a user turn, after an assistant turn. How each state was reached is one byte
a state and row. A conversation that ends within ``block`` rows is traced back at once; of
longer ones the backpointers are spilled as blocks into a written table, and a second stream,
from the last block to the first, traces them back. So memory does not grow with a conversation.

Edits are letters: K keeps a row, R gives it the wanted role, D deletes it, I inserts an empty
turn. From any state a letter leads to one state only, and before a row at most one insert can
pay. So two different ways to one row never are each other's prefix, and the order of the ways
that lead to two states stays what it is whatever follows: a rank of four states is enough to
find the least of the cheapest strings.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txlens.staging import stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Costs of an edit, and of keeping a truncated row.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Ways to take one row, in the order of their letters; the last two insert a turn before.
LETTERS = ("D", "IK", "IR", "K", "R")
ROLES = {USER: "user", ASSISTANT: "assistant"}
SPACE = " \t\n\v\f\r"
#: Rows of a block of backpointers.
BLOCK = 1 << 16
FAR = 1 << 60


def _wanted(state):
    """The only role other than system that may follow a state."""
    return ASSISTANT if state == USER else USER


def _steps(initial, fault):
    """Ways (from, to, cost, letters, inserted role) that a row of that initial and fault allows."""
    ways = [(state, state, DELETE, 0, None) for state in STATES]
    if fault in ("blank", "duplicate"):
        return ways
    more = TRUNCATED if fault == "truncated" else 0
    for state in STATES:
        for inserted in (False, True):
            at = _wanted(state) if inserted else state
            cost, role = more + INSERT * inserted, ROLES[at] if inserted else None
            kept = SYSTEM if initial == "s" and at == START else _wanted(at) if initial == "ua"[_wanted(at) - USER] else None
            if kept is not None:
                ways.append((state, kept, cost, 1 if inserted else 3, role))
            ways.append((state, _wanted(at), cost + REROLE, 2 if inserted else 4, role))
    return ways


STEPS = {(initial, fault): _steps(initial, fault)
         for initial in ("s", "u", "a", "") for fault in ("", "blank", "duplicate", "truncated")}
#: Inserts that end a conversation.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def _ended(digest, state):
    """The running hash after the inserts that end a conversation."""
    for _ in ENDING[state]:
        state = _wanted(state)
        digest = _line(digest, False, ROLES[state], "")
    return digest


def _line(digest, first, role, text):
    digest = digest.copy()
    digest.update((("" if first else "\n") + role + ":" + text).encode())
    return digest


class _Conversation:
    """What is known of one conversation after some of its rows."""

    def __init__(self, conv_id):
        self.conv_id, self.block, self.previous = conv_id, 0, None
        self.cost, self.rank = [0, FAR, FAR, FAR], [0, 1, 2, 3]
        self.digest = [hashlib.sha256()] * 4
        self.pointers = bytearray()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, text, earlier):
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial, fault = role[:1], ""
        seen = text.rstrip(SPACE)
        if not seen:
            fault, self.blank = "blank", self.blank + 1
        elif earlier or self.previous == (turn, role, text):
            fault, self.duplicate = "duplicate", self.duplicate + 1
        elif seen[-1] not in ".!?":
            fault, self.truncated = "truncated", self.truncated + 1
        if self.previous is not None and self.previous[1][:1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.previous = (turn, role, text)
        self._advance(STEPS[initial if initial in ("s", "u", "a") else "", fault], role, text)

    def _advance(self, steps, role, text):
        best = [None] * 4
        for way in steps:
            cost = self.cost[way[0]] + way[2]
            if cost < FAR:
                key = (cost, self.rank[way[0]], way[3])
                if best[way[1]] is None or key < best[way[1]][0]:
                    best[way[1]] = key, way
        cost, digest = [FAR] * 4, [None] * 4
        for state, found in enumerate(best):
            if found is None:
                self.pointers.append(255)
                continue
            (cost[state], _, letters), (source, *_, inserted) = found
            self.pointers.append(source | letters << 2)
            ways = self.digest[source]
            if letters:
                if inserted:
                    ways = _line(ways, source == START, inserted, "")
                named = ROLES[state] if letters in (2, 4) else role
                ways = _line(ways, source == START and not inserted, named, text)
            digest[state] = ways
        order = sorted((s for s in STATES if best[s]), key=lambda s: best[s][0][1:])
        for place, state in enumerate(order):
            self.rank[state] = place
        self.cost, self.digest = cost, digest

    def take_block(self):
        """The spilled backpointers of the rows since the last block."""
        held, self.pointers = bytes(self.pointers), bytearray()
        self.block += 1
        return (self.conv_id, self.block - 1, held, None) + (None,) * 8

    def end(self):
        """The last block, its edits if it is the only one, and what the conversation amounts to."""
        total = [self.cost[s] + INSERT * len(ENDING[s]) for s in STATES]
        state = min(STATES, key=lambda s: (total[s], self.rank[s]))
        summary = (state, 0 if self.low is None else self.high - self.low + 1 - self.turns, self.blank, self.duplicate,
                   self.truncated, self.illegal, total[state], _ended(self.digest[state], state).hexdigest())
        if self.block:
            return (self.conv_id, self.block, bytes(self.pointers), None, *summary)
        edits, _ = traced(self.pointers, state)
        return (self.conv_id, 0, None, edits + ENDING[state], *summary)


def traced(pointers, state):
    """The edits that lead to ``state``, and the state they start from."""
    edits = []
    for at in range(len(pointers) - 4, -1, -4):
        way = pointers[at + state]
        edits.append(LETTERS[way >> 2])
        state = way & 3
    return "".join(reversed(edits)), state


_BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("pointers", pa.binary()), ("edits", pa.string()),
    ("state", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("repaired_sha256", pa.string())])
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "repaired_sha256")


def _table(rows, schema):
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _turns(turns):
    """Rows with plain columns; null roles and texts are empty."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _ordered(rows, *more):
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", *more)


def _with_first_turns(rows):
    """Adds whether the row's role and text stand in an earlier turn of the conversation.

    Rows that repeat are found by a pre-aggregated table of digests; a null turn is the earliest.
    """
    key = [F.col("conv_id"), F.col("role"), F.sha2("text", 256).alias("digest")]
    moment = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeated = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(moment).alias("first")).where("n > 1")
    repeated = stage(repeated.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), "digest", "first"))
    found = rows.withColumn("_digest", F.sha2("text", 256)).join(
        repeated, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
        & (F.col("_digest") == F.col("digest")), "left")
    earlier = F.coalesce(F.col("first") < moment, F.lit(False))
    return found.select("conv_id", "turn", "role", "text", earlier.alias("earlier"))


def edit_blocks(turns, block=BLOCK):
    """The edits of every conversation in blocks (conv_id, block, edits), and its summary.

    The last block of a conversation carries the summary columns.
    """
    def run(batches):
        now, out = None, []
        for batch in batches:
            for conv_id, turn, role, text, earlier in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.end())
                    now = _Conversation(conv_id)
                elif len(now.pointers) >= 4 * block:
                    out.append(now.take_block())
                now.add(turn, role, text, earlier)
            if out:
                yield _table(out, _BLOCKS)
                out = []
        if now is not None:
            yield _table([now.end()], _BLOCKS)

    def back(batches):
        conv_id, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ending = ""
                if row["state"] is not None:
                    state, ending = row["state"], ENDING[row["state"]]
                edits, state = traced(row["pointers"], state)
                out.append((*list(row.values())[:2], None, edits + ending, *list(row.values())[4:]))
            if out:
                yield _table(out, _BLOCKS)

    kinds = "conv_id long, block long, pointers binary, edits string, state long, gaps long, blank long, " \
            "duplicate long, truncated long, illegal long, cost long, repaired_sha256 string"
    found = stage(_ordered(_with_first_turns(_turns(turns))).mapInArrow(run, kinds))
    spilled = found.where("pointers is not null").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return found.where("pointers is null").union(spilled.mapInArrow(back, kinds)).drop("pointers", "state")


def repair(turns, block=BLOCK):
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` needs conv_id, turn, role and text; further columns are ignored. A row's first
    fault counts: blank (no visible character), duplicate (role and text stand earlier),
    truncated (the last visible character is none of ``.!?``). ``illegal`` counts neighbours
    whose role initials are not su, ua or au; ``gaps`` the turn numbers missing between the
    least and the highest. ``audit`` is the least of the cheapest edit strings;
    ``repaired_sha256`` hashes the repaired turns as ``role:text`` lines.

    Rows go by turn, null first, equal turns by role and text; repeated rows are duplicates.
    Null roles and texts are empty; an empty role, as any other that starts with none of ``sua``,
    cannot be kept. Rows with a null conv_id are one conversation. An empty table gives no rows.
    """
    blocks = stage(edit_blocks(turns, block))
    parts = F.sort_array(F.collect_list(F.struct("block", "edits")))
    return blocks.groupBy("conv_id").agg(
        *[F.max(name).alias(name) for name in SUMMARY[:-1]], F.array_join(parts["edits"], "").alias("audit"),
        F.max("repaired_sha256").alias("repaired_sha256"))


def repaired_turns(turns, block=BLOCK):
    """The repaired rows: conv_id, place (from 0), turn (null: inserted), role, text, edit.

    The rows are streamed again in the same order, and the blocks of edits with them.
    """
    rows = _turns(turns)
    first = stage(_ordered(rows).select("conv_id", "turn", "role", "text"))
    edits = edit_blocks(first, block).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "block", "edits")
    none = F.lit(None)
    both = first.select("*", none.cast("long").alias("block"), none.cast("string").alias("edits")).union(edits)
    # edits come first; they are about a byte a row, so those of one conversation are read ahead of it
    order = [F.col("conv_id"), F.col("block").isNull(), F.col("block"), "turn", "role", "text"]
    ordered = both.repartition("conv_id").sortWithinPartitions(*order)
    kinds = "conv_id long, place long, turn long, role string, text string, edit string"
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("edit", pa.string())])

    def run(batches):
        last, left, at, state, place = object(), bytearray(), 0, START, 0

        def inserts():
            nonlocal at, state, place
            while at < len(left) and left[at] == ord("I"):
                state, at = _wanted(state), at + 1
                yield (last, place, None, ROLES[state], "", "I")
                place += 1

        for batch in batches:
            out = []
            for conv_id, turn, role, text, part, edits in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != last:
                    out += inserts()
                    last, left, at, state, place = conv_id, bytearray(), 0, START, 0
                if part is not None:
                    left += edits.encode()
                    continue
                out += inserts()
                letter, at = chr(left[at]), at + 1
                if letter == "D":
                    continue
                after = SYSTEM if letter == "K" and role[:1] == "s" else _wanted(state)
                out.append((conv_id, place, turn, ROLES[after] if letter == "R" else role, text, letter))
                state, place = after, place + 1
            if out:
                yield _table(out, schema)
        if out := list(inserts()):
            yield _table(out, schema)

    return ordered.mapInArrow(run, kinds)


def damaged(conversations):
    """The rows of ``conversations`` with faults put in by a checksum of conversation and turn.

    Nulls are one space (a null conv_id or turn in the checksum's text only). Of 20 rows one is
    dropped, one emptied, one loses its stops, one is repeated and one becomes a user's.
    """
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("long").cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(20)).alias("fate"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_damaged(conversations):
    """``repair`` of the damaged rows, for every conv_id there was before the damage."""
    found = repair(damaged(conversations)).withColumnRenamed("conv_id", "_conv")
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    empty = hashlib.sha256().hexdigest()
    return both.select(
        "conv_id", *[F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in SUMMARY[:-1]],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
