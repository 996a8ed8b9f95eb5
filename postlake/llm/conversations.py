"""Repair of conversation structure: the cheapest edits that make roles alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks, closing marks, and what each edit costs. An insertion or a new role costs the same.
BLANKS = "\x20\t\n\x0b\x0c\r"
CLOSING = (".", "!", "?")
DELETE, CHANGE, TRUNCATED = 3, 2, 1

# Where a repaired conversation stands: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
# The state that the next user or assistant row leads to; which of the two it must be follows from the state.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# Insertions that end a conversation properly.
ENDING = (0, 2, 1, 0)

# What happens up to and with one row: some insertions, then the row is deleted, kept or given a role. In the order of
# their letters, so the first of equally cheap moves gives the least audit. Three insertions only lead to where one does.
MOVES = sorted("I" * n + last for n in range(3) for last in "DKR")

FAULTS = ("blank", "duplicate", "truncated")


def _after(state: int, insertions: int) -> int:
    for _ in range(insertions):
        state = NEXT[state]
    return state


def cheapest_moves(initial: str, fault: int, ahead: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """Best move of a row from every state, and what it and all rows after it cost.

    ``fault`` counts FAULTS from 1. ``ahead`` is the cost of the rows after it by state. The moves of the four states
    are packed, four bits each.
    """
    packed, costs = 0, []
    for state in range(4):
        best = None
        for k, move in enumerate(MOVES):
            here = _after(state, len(move) - 1)
            cost = CHANGE * (len(move) - 1)
            if move[-1] == "D":
                cost += DELETE
            elif fault in (1, 2):
                continue
            else:
                cost += TRUNCATED if fault == 3 else 0
                if move[-1] == "R":
                    cost += CHANGE
                    here = NEXT[here]
                elif initial == "s" and here == START:
                    here = SYSTEM
                elif initial and initial == INITIALS[NEXT[here] - 1]:
                    here = NEXT[here]
                else:
                    continue
            cost += ahead[here]
            if best is None or cost < best[0]:
                best = (cost, k)
        costs.append(best[0])
        packed |= best[1] << (4 * state)
    return packed, tuple(costs)


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows from the last turn to the first: add to each its packed moves.

    Only four costs are carried from row to row and from batch to batch. They differ by little, so after their smallest
    is taken off, few combinations occur and each is worked out once.
    """
    known: dict[tuple, tuple] = {}
    ending = tuple(CHANGE * n for n in ENDING)
    here, ahead = object(), ending
    for frame in frames:
        moves = np.zeros(len(frame), np.int32)
        columns = (frame[c].tolist() for c in ("_key", "_initial", "_fault", "_lost"))
        for at, (key, initial, fault, lost) in enumerate(zip(*columns)):
            if key != here:
                here, ahead = key, ending
            if lost:
                continue
            case = (initial, fault, ahead)
            step = known.get(case)
            if step is None:
                packed, costs = cheapest_moves(initial, fault, ahead)
                low = min(costs)
                step = known[case] = packed, tuple(c - low for c in costs)
            moves[at], ahead = step
        frame["_moves"] = moves
        yield frame


class _Repair:
    """One conversation as its rows pass by: counters, the audit, and the hash of the repaired rows."""

    def __init__(self, conversation: object) -> None:
        self.conversation = conversation
        self.turns = self.low = self.high = self.last = None
        self.initial = None
        self.faults = [0, 0, 0, 0]
        self.illegal = self.cost = self.rows = 0
        self.state, self.audit, self.hash = START, bytearray(), hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        if self.rows:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode("utf-8", "replace"))
        self.rows += 1

    def _insert(self) -> None:
        self.state = NEXT[self.state]
        self._put(NAMES[self.state], "")
        self.cost += CHANGE

    def take(self, turn: int | None, role: str, text: str, initial: str, fault: int, moves: int) -> None:
        if turn is not None:
            if self.turns is None:
                self.turns, self.low = 0, turn
            self.turns += turn != self.high
            self.high = turn
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.faults[fault] += 1
        move = MOVES[moves >> (4 * self.state) & 15]
        self.audit += move.encode()
        for _ in move[:-1]:
            self._insert()
        if move[-1] == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if fault == 3 else 0
        if move[-1] == "R":
            self.state = NEXT[self.state]
            self.cost += CHANGE
            role = NAMES[self.state]
        else:
            self.state = SYSTEM if initial == "s" else NEXT[self.state]
        self._put(role, text)

    def result(self) -> tuple:
        for _ in range(ENDING[self.state]):
            self.audit += b"I"
            self._insert()
        gaps = 0 if self.turns is None else self.high - self.low + 1 - self.turns
        return (self.conversation, gaps, *self.faults[1:], self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
AT_ONCE = 2_000


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows from the first turn to the last: follow the moves, one result per conversation."""
    here, repair, done = object(), None, []
    for frame in frames:
        turns = [None if pd.isna(t) else int(t) for t in frame["turn"].tolist()]
        columns = (frame[c].tolist() for c in ("_key", "conversation_id", "role", "text", "_initial", "_fault", "_lost", "_moves"))
        for turn, key, conversation, role, text, initial, fault, lost, moves in zip(turns, *columns):
            if key != here:
                if repair is not None:
                    done.append(repair.result())
                here, repair = key, _Repair(None if pd.isna(conversation) else conversation)
            if not lost:
                repair.take(turn, role, text, initial, fault, moves)
        if len(done) >= AT_ONCE:
            yield _results(done)
            done = []
    if repair is not None:
        done.append(repair.result())
    if done:
        yield _results(done)


def _results(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conversation_id", *RESULT], dtype=object)
    return out


def with_faults(turns: DataFrame) -> DataFrame:
    """Add each row's first fault, counted from 1 in FAULTS, 0 for none.

    Rows must lie together by conversation. Equal rows of a conversation are numbered along its turns; sorting them does it,
    so a conversation of any length needs no set of what it said before.
    """
    same = Window.partitionBy("_key", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    closed = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(F.col("_lost"), 0)
        .when(closed == "", 1)
        .when(F.col("_nth") > 1, 2)
        .when(~F.right(closed, F.lit(1)).isin(*CLOSING), 3)
        .otherwise(0)
    )
    # A row that is lost is none that others repeat.
    numbered = turns.withColumn("_nth", F.sum(F.when(F.col("_lost"), 0).otherwise(1)).over(same.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.withColumn("_fault", fault.cast("int"))


def repair_conversations(turns: DataFrame, lost: Column | None = None) -> DataFrame:
    """The cheapest edits that make every conversation's roles read system at most once, then user and assistant in turn.

    General: posts, pages and runs of this project hold no dialogue. ``turns`` has ``conversation_id``, ``turn``, ``role`` and
    ``text``; other columns are not read. ``lost`` marks rows that are known to be missing: their conversation is returned,
    they themselves take no part.

    Rows count by turn, null turns first, rows of one turn by role and text. A row's first fault counts: blank (nothing but blanks),
    duplicate (role and text came before in the conversation), truncated (its last character but blanks closes no
    sentence). Keeping a row costs nothing, a new role 2, deleting 3, an inserted row without text 2; blank and duplicate rows
    must go, a truncated row that stays costs 1. Of equally cheap repairs the one with the least audit is taken.

    Returns per conversation ``conversation_id``, ``gaps`` (turn numbers missing between the first and the last), ``blank``,
    ``duplicate`` and ``truncated`` (rows by first fault), ``illegal`` (neighbouring rows that are not system-user,
    user-assistant or assistant-user, by the roles' first letters), ``cost``, ``audit`` (a letter per edit: Delete, Insert, Keep, Rerole)
    and ``repaired_sha256`` of the repaired rows, ``role:text`` joined by newlines.

    Method: rows meet by conversation and are sorted twice in place. From the last turn to the first, four costs are
    carried over the rows and each row notes in 16 bits the best move from every state; back from the first turn to the last the
    moves are followed. Notes travel with their rows, so Spark's sort spills them for a conversation of any length,
    and a lost executor costs its partitions' repetition. What grows with a conversation in memory is its audit, one byte a row.

    A null conversation id is one conversation. A null role or text counts as one space: such a role is none of the three, such a
    text is blank. Repeated rows are duplicates. A conversation without rows left has zeros, an empty audit and the hash
    of nothing. Very long texts pass through row by row. An empty table gives an empty result.
    """
    kind = turns.schema["conversation_id"].dataType
    rows = turns.select(
        "conversation_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(lost, F.lit(False)).alias("_lost") if lost is not None else F.lit(False).alias("_lost"),
        F.coalesce(F.concat(F.lit("="), F.col("conversation_id").cast("string")), F.lit("?")).alias("_key"),
    )
    met = with_faults(rows.repartition("_key")).withColumn("_initial", F.left("role", F.lit(1)))
    order = ("turn", "role", "text", "_nth")
    noted = met.sortWithinPartitions("_key", F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in order[1:]])
    noted = noted.mapInPandas(_backward, T.StructType(list(noted.schema.fields)).add("_moves", T.IntegerType()))
    again = noted.sortWithinPartitions("_key", F.col("turn").asc_nulls_first(), *order[1:])
    counts = [T.StructField(c, T.LongType()) for c in RESULT[:6]]
    texts = [T.StructField(c, T.StringType()) for c in RESULT[6:]]
    return again.mapInPandas(_forward, T.StructType([T.StructField("conversation_id", kind), *counts, *texts]))
