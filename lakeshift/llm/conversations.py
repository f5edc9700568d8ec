"""Conversation structure repair by secondary-sorted streaming (operator 11).

Repaired roles read ``(system? (user assistant)+)?``. A row is kept (cost 0), given the role user
or assistant (3) or deleted (4; blank and duplicate rows always); an empty user or assistant row
may be put anywhere (3); a truncated row that stays adds 3. Of the cheapest repairs the one whose
edit initials (D, I, K, R) come first in ASCII order holds.

1. *Faults.* Blank and truncated are Column expressions. Repeats are found on slim rows: texts
   become 128-bit digests, their earliest turn is a combined minimum per (conversation, role,
   digest), so one text repeated in a giant conversation costs a row a task.
2. *Costs.* Slim rows are repartitioned by conversation and sorted by falling turn. The stream
   carries four numbers over Arrow batches: the cost of everything behind a row from each state
   of the grammar. A row's best moves from the four states are its backpointer, two bytes. Every
   ``BLOCK_ROWS`` rows the backpointers leave the task as a row of a written table (the spill), so
   memory does not grow with a conversation.
3. *Repair.* Texts are repartitioned by conversation and sorted by rising turn, each block of
   backpointers in front of its first row. The stream follows one state through them, so the
   first edit by ASCII order is always at hand, and hashes the repaired rows as they pass.

One conversation is one stream in one task, by the method: a giant one takes long but no memory
(but for its own audit text, a byte a row).

Defined results: turns sort with nulls first, rows of one turn by role and digest of the text;
null roles and texts are one space, which is no legal role and a blank text; an empty role is no
legal role; a null conv_id is a conversation of its own; rows repeated whole are duplicates of each
other; gaps beyond 64 bits are cut there; a conversation that lost all rows has zeros, no audit and
the hash of no text; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import struct
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import load, stored, text_digest, with_workers

#: Costs of the edits, white space, closing marks.
RETITLE, DELETE, INSERT, OPEN_END = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
MARKS = ".!?"
BLOCK_ROWS = 1 << 16

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State behind a kept role initial; state behind an inserted or retitled row.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
FORCED = (USER, USER, ASSISTANT, USER)
NAMES = ("user", "user", "assistant", "user")
#: Cost behind the last row from each state, and the inserts that it is made of.
AT_END = (0, 2 * INSERT, INSERT, 0)
TAIL = (0, 2, 1, 0)
EDITS = "DKR"
PAIRS = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PACKED = struct.Struct("<6q")
ORDER = ("_conv", "_has", "_turn", "role", "_digest")
KEYS = "_conv string, _has boolean, _turn long, role string, _digest binary"
MOST = (1 << 63) - 1


@lru_cache(maxsize=4096)
def step(behind: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs from each state before a row, from those behind it, and the packed best moves.

    A move takes four bits a state: three times the inserts before the row, plus the edit of the row.
    """
    extra = OPEN_END if fault == TRUNCATED else 0
    cost, edit = [], []
    for q in range(4):
        options = [(DELETE + behind[q], "D")]
        if fault not in (BLANK, DUPLICATE):
            if (q, initial) in KEPT:
                options.append((extra + behind[KEPT[q, initial]], "K"))
            options.append((RETITLE + extra + behind[FORCED[q]], "R"))
        cost.append(min(c for c, _ in options))
        edit.append(options)
    for _ in range(3):  # two inserts lead everywhere
        cost = [min(c, INSERT + cost[FORCED[q]]) for q, c in enumerate(cost)]
    first = [min([e for c, e in edit[q] if c == cost[q]] + ["I"] * (INSERT + cost[FORCED[q]] == cost[q])) for q in range(4)]
    moves = 0
    for q in range(4):
        inserts, at = 0, q
        while first[at] == "I":
            inserts, at = inserts + 1, FORCED[at]
        moves |= (3 * inserts + EDITS.index(first[at])) << 4 * q
    return tuple(cost), moves


class Falling:
    """One conversation read from its last row to its first."""

    def __init__(self, conv: str) -> None:
        self.conv, self.base, self.behind, self.moves, self.seq = conv, 0, AT_END, [], 0
        self.faults, self.illegal, self.after = [0] * 4, 0, None
        self.high = self.low = None
        self.turns = 0

    def add(self, row: tuple, repeated: bool) -> None:
        conv, has, turn, role, digest, fault = row
        if repeated and fault != BLANK:
            fault = DUPLICATE
        initial = role[:1]
        self.faults[fault] += 1
        if self.after is not None and initial + self.after not in PAIRS:
            self.illegal += 1
        self.after = initial
        if has:
            self.turns += turn != self.low
            self.high, self.low = turn if self.high is None else self.high, turn
        costs, moves = step(self.behind, initial if initial in {"s", "u", "a"} else "?", fault)
        least = min(costs)
        self.base += least
        self.behind = tuple(c - least for c in costs)
        self.moves.append(moves)

    def block(self, row: tuple, head: bool) -> tuple:
        """The backpointers since the last block, in rising order, at the place of their first row."""
        moves, counts = np.array(self.moves[::-1], "<u2").tobytes(), None
        if head:
            gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, MOST)
            counts = PACKED.pack(gaps, *self.faults[1:], self.illegal, self.base + self.behind[START])
        self.moves, self.seq = [], self.seq + 1
        return (*row[:5], self.seq, moves, counts)


BLOCKS = f"{KEYS}, seq int, moves binary, counts binary"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return pd.DataFrame({n: pd.Series([r[k] for r in rows], dtype=object) for k, n in enumerate(names)})


def cost_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Slim rows sorted by conversation and falling place -> blocks of backpointers."""
    run, held, out = None, None, []  # held: the row before, until it is known whether it repeats the next
    for frame in frames:
        for row in zip(*(frame[c].tolist() for c in (*ORDER, "fault"))):
            if held is not None:
                same = held[0] == row[0]
                run.add(held, same and held[1:5] == row[1:5])
                if not same or len(run.moves) >= BLOCK_ROWS:
                    out.append(run.block(held, not same))
            if run is None or run.conv != row[0]:
                run = Falling(row[0])
            held = row
        if out:
            yield _frame(out, BLOCKS)
            out = []
    if held is not None:
        run.add(held, False)
        yield _frame([run.block(held, True)], BLOCKS)


class Rising:
    """One conversation read from its first row to its last along its backpointers."""

    def __init__(self, conv: str) -> None:
        self.conv, self.state, self.blocks, self.audit, self.counts = conv, START, deque(), bytearray(), None
        self.hash, self.place = hashlib.sha256(), 0

    def put(self, role: str, text: str) -> tuple[int, str, str]:
        if self.place:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.place += 1
        return self.place, role, text

    def insert(self, n: int) -> Iterator[tuple]:
        for _ in range(n):
            self.audit += b"I"
            yield (*self.put(NAMES[self.state], ""), "insert")
            self.state = FORCED[self.state]

    def add(self, role: str, text: str) -> Iterator[tuple]:
        """The repaired rows up to and with this one: (place, role, text, edit)."""
        moves = self.blocks[0]
        inserts, edit = divmod(next(moves) >> 4 * self.state & 15, 3)
        if not moves.__length_hint__():
            self.blocks.popleft()
        yield from self.insert(inserts)
        self.audit += EDITS[edit].encode()
        if EDITS[edit] == "K":
            yield (*self.put(role, text), "keep")
            self.state = KEPT[self.state, role[:1]]
        elif EDITS[edit] == "R":
            yield (*self.put(NAMES[self.state], text), "retitle")
            self.state = FORCED[self.state]

    def end(self) -> Iterator[tuple]:
        yield from self.insert(TAIL[self.state])

    def summary(self) -> tuple:
        return (self.conv, *self.counts, self.audit.decode(), self.hash.hexdigest())


SUMMARY = f"_conv string, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
TURNS = "_conv string, place long, role string, text string, edit string"


def repair_frames(frames: Iterator[pd.DataFrame], turns: bool) -> Iterator[pd.DataFrame]:
    """Texts in rising order, blocks of backpointers in front of their first row -> the repaired
    rows, or a summary of each conversation."""
    run, out, schema = None, [], TURNS if turns else SUMMARY

    def take(rows: Iterator[tuple]) -> None:
        for r in rows:
            if turns:
                out.append((run.conv, *r))

    def close() -> None:
        take(run.end())
        if not turns:
            out.append(run.summary())

    for frame in frames:
        for conv, role, text, moves, counts in zip(*(frame[c].tolist() for c in ("_conv", "role", "text", "moves", "counts"))):
            if run is None or run.conv != conv:
                if run is not None:
                    close()
                run = Rising(conv)
            if moves is not None:
                run.blocks.append(iter(np.frombuffer(moves, "<u2").tolist()))
                if run.counts is None:  # the first block holds the counts
                    run.counts = PACKED.unpack(counts)
            else:
                take(run.add(role, text))
        if out:
            yield _frame(out, schema)
            out = []
    if run is not None:
        close()
        yield _frame(out, schema)


def _conv_key() -> Column:
    """Never null, so joins on it are plain."""
    return F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _placed(rows: DataFrame) -> DataFrame:
    """Keys, text and own fault (blank or truncated) of each row."""
    turn, text = F.col("turn").cast("long"), _filled("text")
    body = F.rtrim(text, F.lit(SPACES))
    fault = (F.when(body == "", BLANK).when(F.right(body, F.lit(1)).isin(*MARKS), SOUND).otherwise(TRUNCATED))
    return rows.select(_conv_key().alias("_conv"), turn.isNotNull().alias("_has"), F.coalesce(turn, F.lit(0)).alias("_turn"),
                       _filled("role").alias("role"), text_digest(text).alias("_digest"), fault.alias("fault"), text.alias("text"))


def backpointers(rows: DataFrame) -> DataFrame:
    """Written blocks of backpointers, and the counts of each conversation in its first block."""
    slim = _placed(rows).drop("text")
    same = ["_conv", "role", "_digest"]
    place = F.struct("_has", "_turn")
    first = slim.groupBy(*same).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    fault = F.when((F.col("fault") != BLANK) & (place > F.col("_first")), DUPLICATE).otherwise(F.col("fault"))
    slim = slim.join(first, same, "left").select(*ORDER, fault.cast("int").alias("fault"))
    falling = [F.col(c).desc() for c in ORDER[1:]]
    return stored(slim.repartition("_conv").sortWithinPartitions("_conv", *falling).mapInPandas(cost_frames, BLOCKS), "repair-blocks")


def _repaired(rows: DataFrame, turns: bool) -> DataFrame:
    with_workers(rows.sparkSession)
    blocks = backpointers(rows).withColumn("text", F.lit(None).cast("string"))
    texts = _placed(rows).drop("fault")
    for f in blocks.schema.fields:
        if f.name not in texts.columns:
            texts = texts.withColumn(f.name, F.lit(None).cast(f.dataType))
    both = texts.unionByName(blocks).repartition("_conv").sortWithinPartitions(
        *ORDER, F.col("seq").desc_nulls_last())  # a block stands before the rows of its place, the later ones of a place last
    return both.mapInPandas(lambda frames: repair_frames(frames, turns), TURNS if turns else SUMMARY)


def _with_id(found: DataFrame, rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    conv = F.when(F.col("_conv") != "", F.substr("_conv", F.lit(2))).cast(kind)
    return found.select(conv.alias("conv_id"), *found.columns[1:])


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit and repaired_sha256 of each conversation of ``rows``
    (conv_id, turn, role, text)."""
    return _with_id(_repaired(rows, False), rows)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired rows themselves: conv_id, place (from 1), role, text, edit (keep, retitle, insert)."""
    return _with_id(_repaired(rows, True), rows)


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage: by crc32 of ``conv_id:turn`` mod 20 a row is dropped (0), emptied (1), loses
    its closing marks (2), is repeated (3) or given to the user (4); nulls are one space."""
    draw = F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.translate(_filled("text"), MARKS, "")).otherwise(_filled("text"))
    role = F.when(draw == 4, "user").otherwise(_filled("role"))
    copies = F.explode(F.when(draw == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    return conversations.filter(draw != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("_copy")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``repair(rows)`` with a row for every conv_id of ``conversations``, also those without rows."""
    ids = conversations.select("conv_id").distinct().select("conv_id", _conv_key().alias("_key"))
    found = repair(rows).select(_conv_key().alias("_conv"), *COUNTS, "audit", "repaired_sha256")
    nothing = hashlib.sha256(b"").hexdigest()
    return ids.join(found, ids["_key"] == found["_conv"], "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))
