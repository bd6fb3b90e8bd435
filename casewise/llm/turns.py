"""Conversation structure repair by a dynamic program over secondary-sorted streams.

A conversation is repaired to the role pattern ``(s?(ua)+)?`` (role initials) by the cheapest
edits: Keep 0, Rerole to user/assistant 1, Delete 2 (required for blank and duplicate rows),
Insert an empty user/assistant turn 5; a truncated row that stays costs 5 more.  Of equally
cheap edit lists the one whose initials are least in ASCII order is taken.

The pattern has four states (nothing yet, after the system turn, after user, after assistant).
Going backwards over the turns, a vector of four least costs is all the state there is, and the
first letter of the best list from each state is two bits, so a turn's backpointers are one byte.
Going forwards, these bytes give the edits.

* Ordinary conversations: rows are repartitioned by conversation and sorted by turn; mapInPandas
  carries the rows of the open conversation across Arrow batches and does both ways in memory.
* Giant conversations (more than ``rows`` rows or ``chars`` characters, found by an aggregate)
  are never held.  Duplicates are found by grouping; a stream in descending order carries the
  four costs across batches and spills the one-byte backpointers to the shared folder; a stream
  in ascending order reads them beside the rows, carries one state and emits the edits.

Both ways give the same edits.  ``repair`` returns them as rows, each conversation's in order
inside one partition; ``summaries`` folds them into counts, audit and a digest as they pass.

Defined edge cases: a null role or text is one space; null turns come first; rows of one turn
are taken by role, then by the MD5 of their text; a null conversation id is a conversation of
its own; a role's initial is its first character (none if empty); repeated rows are
duplicates; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
#: A conversation beyond either bound is repaired by the two spilling streams.
ROWS, CHARS = 20_000, 1 << 23
#: Letters in ASCII order, as two-bit codes.
D, I, K, R = range(4)
LETTERS = "DIKR"
NEXT = (2, 2, 3, 2)  # state after inserting or reroling: user, user, assistant, user
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
NEVER = 1 << 60
END = (0, 10, 5, 0)  # cost of ending in a state: what is missing is inserted
NAMES = {2: "user", 3: "assistant"}
EDITS = "conv string, edit string, fault string, turn string, was string, role string, text string"


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) of every row; nulls of role and text are one space, conv is text."""
    return rows.select(F.col(f"`{conv_col}`").cast("string").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"))


def _fault() -> Column:
    """blank or truncated, else null (duplicates depend on other rows)."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    return F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")


def back(after: list[int], initial: str, fault: str | None) -> tuple[list[int], int]:
    """Least costs before a row from those after it, and the row's backpointer byte."""
    free = fault not in ("blank", "duplicate")
    more = 5 if fault == "truncated" else 0
    ways = []
    for q in range(4):
        to = KEEP.get((initial, q)) if free else None
        ways.append([2 + after[q], NEVER, NEVER if to is None else more + after[to],
                     1 + more + after[NEXT[q]] if free else NEVER])
    least = [min(w) for w in ways]
    # inserting: states 2 and 3 reach each other, a second insertion in a row never pays there
    two, three = min(least[2], 5 + least[3]), min(least[3], 5 + least[2])
    cost = [min(least[0], 5 + two), min(least[1], 5 + two), two, three]
    byte = 0
    for q in range(4):
        ways[q][I] = 5 + cost[NEXT[q]]
        byte |= ways[q].index(cost[q]) << 2 * q
    return cost, byte


class Edits:
    """Collects edit rows for one output batch."""

    def __init__(self):
        self.rows: list[tuple] = []

    def insert(self, conv: str | None, q: int) -> int:
        q = NEXT[q]
        self.rows.append((conv, "I", None, None, None, NAMES[q], ""))
        return q

    def row(self, conv: str | None, turn: str | None, role: str, text: str, fault: str | None, byte: int, q: int) -> int:
        """The edits up to and including this row; returns the state after it."""
        while (letter := byte >> 2 * q & 3) == I:
            q = self.insert(conv, q)
        kept = role if letter == K else None
        if letter == K:
            q = KEEP[role[:1], q]
        elif letter == R:
            q = NEXT[q]
            kept = NAMES[q]
        self.rows.append((conv, LETTERS[letter], fault, turn, role, kept, None if letter == D else text))
        return q

    def end(self, conv: str | None, q: int) -> None:
        while END[q]:
            q = self.insert(conv, q)

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=["conv", "edit", "fault", "turn", "was", "role", "text"], dtype=object)
        self.rows = []
        return out


def _lists(batch: pd.DataFrame) -> zip:
    return zip(*[[None if x is None or x != x else x for x in batch[c].tolist()] for c in batch.columns], strict=True)


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (conv, turn, role, text, fault) to edits; holds one conversation."""
    out, held, seen, now = Edits(), [], set(), None

    def close() -> None:
        cost, moves = list(END), bytearray(len(held))
        for i in range(len(held) - 1, -1, -1):
            cost, moves[i] = back(cost, held[i][2][:1], held[i][4])
        q = 0
        for row, byte in zip(held, moves, strict=True):
            q = out.row(*row, byte, q)
        out.end(now, q)

    for batch in batches:
        for conv, turn, role, text, fault in _lists(batch):
            if held and conv != now:
                close()
                held, seen = [], set()
            now = conv
            same = (role, text)
            if fault != "blank" and same in seen:
                fault = "duplicate"
            seen.add(same)
            held.append((conv, turn, role, text, fault))
        if out.rows:
            yield out.frame()
    if held:
        close()
        yield out.frame()


def _spill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in descending order (conv, initial, fault, uid, copy) to backpointers (uid, copy, moves)."""
    cost, now, started = list(END), None, False
    for batch in batches:
        moves = []
        for conv, initial, fault, _uid, _copy in _lists(batch):
            if not started or conv != now:
                cost, now, started = list(END), conv, True
            cost, byte = back(cost, initial, fault)
            moves.append(byte)
        yield pd.DataFrame({"uid": batch["uid"], "copy": batch["copy"], "moves": moves})


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in ascending order with their backpointers (conv, turn, role, text, fault, moves) to edits."""
    out, q, now, started = Edits(), 0, None, False
    for batch in batches:
        for conv, turn, role, text, fault, byte in _lists(batch):
            if started and conv != now:
                out.end(now, q)
                q = 0
            now, started = conv, True
            q = out.row(conv, turn, role, text, fault, int(byte), q)
        if out.rows:
            yield out.frame()
    if started:
        out.end(now, q)
        yield out.frame()


def _giants(given: DataFrame) -> DataFrame:
    """Edits of conversations that no task may hold."""
    g = stored(given.withColumn("uid", F.monotonically_increasing_id()), "turns-giant")
    # equal rows differ in turn, uid and copy only: the least of these is the first
    first = g.groupBy("conv", "role", "tie").agg(F.min(F.struct("turn", "uid", "copy")).alias("f"))
    first = first.select("f.uid", "f.copy", F.lit(True).alias("first"))
    fault = F.when(_fault() == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(_fault())
    g = stored(g.join(first, ["uid", "copy"], "left").withColumn("fault", fault).drop("first"), "turns-faults")
    down = g.repartition("conv").sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("tie"), F.desc("uid"),
                                                      F.desc("copy"))
    moves = down.select("conv", F.left("role", F.lit(1)).alias("initial"), "fault", "uid", "copy").mapInPandas(
        _spill, "uid long, copy int, moves int")
    up = g.join(stored(moves, "turns-moves"), ["uid", "copy"]).repartition("conv").sortWithinPartitions(
        "conv", F.asc_nulls_first("turn"), "role", "tie", "uid", "copy")
    return up.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "moves").mapInPandas(_walk, EDITS)


def repair(rows: DataFrame, rows_bound: int = ROWS, chars_bound: int = CHARS) -> DataFrame:
    """The edits of every conversation of ``rows`` (as ``turns`` returns them, ``copy`` numbers equal rows).

    Columns: conv, edit (D, I, K or R), fault (blank, duplicate, truncated or null), turn and was (turn and
    role before; null if inserted), role and text (after; null if deleted).
    """
    rows = rows.withColumn("tie", F.md5(F.col("text").cast("binary")))
    size = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))
    giant = stored(size.filter((F.col("n") > rows_bound) | (F.col("chars") > chars_bound)).select(F.col("conv").alias("big")), "turns-sizes")
    same = F.col("conv").eqNullSafe(F.col("big"))
    none = giant.isEmpty()
    small = rows if none else rows.join(giant, same, "left_anti")
    # a conversation of its own hash range each: the rows of one are together and in order
    small = small.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "tie")
    out = small.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", _fault().alias("fault")).mapInPandas(_whole, EDITS)
    return out if none else out.unionByName(_giants(rows.join(giant, same, "left_semi")))


SUMMARY = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


class Summary:
    """What is reported of one conversation, kept up to date edit by edit."""

    def __init__(self, conv: str | None):
        self.conv, self.audit, self.digest, self.cost = conv, bytearray(), hashlib.sha256(), 0
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.before = None
        self.distinct = self.illegal = self.lines = 0
        self.last: str | None = None

    def add(self, edit: str, fault: str | None, turn: str | None, was: str | None, role: str | None, text: str | None) -> None:
        self.audit += edit.encode()
        self.cost += {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + (5 if fault == "truncated" and edit != "D" else 0)
        if edit != "I":
            if fault:
                self.count[fault] += 1
            if turn is not None and turn != self.before:  # turns ascend
                self.distinct += 1
                self.low, self.high, self.before = int(turn) if self.low is None else self.low, int(turn), turn
            if self.last is not None and self.last + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = was[:1]
        if edit != "D":
            self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.count.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now = None
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    for batch in batches:
        done = []
        for conv, *edit in _lists(batch):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                now = Summary(conv)
            now.add(*edit)
        if done:
            yield pd.DataFrame(done, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result: fault counts, cost, audit and the repaired lines' SHA-256."""
    return edits.mapInPandas(_fold, SUMMARY)


def damaged(rows: DataFrame) -> DataFrame:
    """``turns`` rows with faults put in by crc32 of ``conv:turn`` modulo 20 (0 to 4; null: one space), and ``copy``."""
    one = F.lit(" ")
    name = F.concat(F.coalesce("conv", one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    hit = F.crc32(name.cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter(hit != 0).select(
        "conv", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def damage_and_repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", **bounds) -> DataFrame:
    """One row per conversation id of ``rows``, those without rows after the damage included."""
    given = turns(rows, conv_col, turn_col, role_col, text_col)
    found = summaries(repair(damaged(given), **bounds))
    ids = rows.select(F.col(f"`{conv_col}`").alias("id")).distinct()
    out = ids.join(found, F.col("id").cast("string").eqNullSafe(F.col("conv")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias(conv_col), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
