"""Conversation structure repair by Wagner-Fischer alignment to the role grammar ``(s?(ua)+)?``.

A conversation's turns are aligned to each string of the grammar whose length is feasible: Keep (0) and Rerole
(1, to user or assistant) match a turn with a place of the string, Delete (2) leaves the turn out, Insert (5)
fills a place with an empty turn, a truncated turn that stays costs 5 more. Lengths are tried from the least
possible cost on; the cheapest cost so far (the incumbent) rules out lengths and, in the table of a length,
all cells whose surplus of turns or places alone would cost more (Ukkonen's band). The edits are traced back
with the ASCII-least letter first; of lengths that cost the same the ASCII-least audit wins.

Conversations of more than ``BLOCK`` turns are aligned block by block from the last to the first, from each of
the four positions in the grammar that a block can start at, to the pieces of grammar strings that follow.
Places are inserted before a turn (after the last one, at the end), so no audit of a block is the start of
another and the least audit of the whole starts with the least one of its first block. A block's answer is
kept for the next conversation with the same kinds of turns.

Spark deals rows by conversation and sorts them; a task reads the kinds of a conversation's turns first
(a byte a turn, without texts), aligns, and then hashes or returns its texts as they stream by. The SHA-256
of one conversation is one sequence, so one conversation is read by one task, whatever its size, in batches.

Defined results: null conversation ids are one conversation; a null turn sorts first and has no part in gaps;
null roles and texts are one space; rows with the same turn are taken by role, then text; repeated rows are
duplicates of the first; an empty table gives an empty table; only the four named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsevault.llm.common import executors_ready

DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
#: Turns that are aligned at a time.
BLOCK = 64
#: Blocks whose answers a task keeps.
MEMO = 50_000
_WHITE = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60
#: Kinds of turns: the role's initial and whether the turn must go (1) or is truncated (2).
_INITIALS = "sua?"
_FREE, _MUST_GO, _TRUNCATED = 0, 1, 2
#: Positions in the grammar: nothing yet, after s, after u, after a. Strings may end at the first and the last.
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, lost): every turn with the damage that its crc32 deals it; a dropped turn
    stays as a row that is ``lost``, so that its conversation is not forgotten."""
    space = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    rows = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"), space(role_col).alias("role"),
                        space(text_col).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("fault") == 0).alias("lost"), F.explode(times).alias("copy")).drop("copy")


# -- alignment ------------------------------------------------------------------------------------------------------


def aligned(kinds: list[tuple[str, int]], target: str, at_end: bool, budget: int) -> tuple[int, str] | None:
    """(cost, ASCII-least audit) of the cheapest alignment of the turns to ``target``, if it costs ``budget``
    at most; places after the last turn are filled only ``at_end``."""
    n, size = len(kinds), len(target)
    least = lambda k: max(INSERT * k, -DELETE * k)  # noqa: E731  of an offset (places - turns)
    if least(size - n) > budget:
        return None
    low, high = min(0, size - n), max(0, size - n)
    while least(low - 1) + least(size - n - low + 1) <= budget and low > -n:
        low -= 1
    while least(high + 1) + least(size - n - high - 1) <= budget and high < size:
        high += 1
    width = high - low + 1
    table = [[_NEVER] * (width + 2) for _ in range(n + 2)]  # [turn][offset - low + 1], one cell of margin
    for i in range(n, -1, -1):
        row, under = table[i], table[i + 1]
        for j in range(min(size, i + high), max(0, i + low) - 1, -1):
            at = j - i - low + 1
            best = _NEVER
            if i == n:
                if j == size:
                    best = 0
                elif at_end and target[j] != "s":
                    best = INSERT + row[at + 1]
            else:
                initial, fault = kinds[i]
                best = DELETE + under[at - 1]
                if j < size:
                    place = target[j]
                    if place != "s" and INSERT + row[at + 1] < best:
                        best = INSERT + row[at + 1]
                    if fault != _MUST_GO and (initial == place or place != "s"):
                        cost = (initial != place) * REROLE + (fault == _TRUNCATED) * CUT + under[at]
                        best = min(best, cost)
            row[at] = best
    start = 1 - low
    if table[0][start] > budget:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < size:
        at, cost = j - i - low + 1, table[i][j - i - low + 1]
        if i < n and cost == DELETE + table[i + 1][at - 1]:
            audit.append("D")
            i += 1
        elif j < size and target[j] != "s" and cost == INSERT + table[i][at + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if kinds[i][0] == target[j] else "R")
            i, j = i + 1, j + 1
    return table[0][start], "".join(audit)


def _pieces(entry: int):
    """(piece, position after it) of the grammar strings from a position on, by length; endless."""
    pieces = [("", entry)]
    while True:
        yield from pieces
        longer = []
        for piece, at in pieces:
            if at == _START:
                longer.append((piece + "s", _AFTER_S))
            longer.append((piece + "a", _AFTER_A) if at == _AFTER_U else (piece + "u", _AFTER_U))
        pieces = longer


def cheapest(kinds: list[tuple[str, int]], entry: int, exits: tuple[int, ...], at_end: bool) -> tuple[int, str, int]:
    """(cost with what follows, ASCII-least audit, position reached) of the turns from ``entry`` on;
    ``exits``: what the rest costs from each position."""
    n = len(kinds)
    if not any(e < _NEVER for e in exits):
        return _NEVER, "", entry
    # some way always exists: all turns deleted, two places filled, and an s deleted that the rest could keep
    limit = DELETE * (n + 1) + INSERT * 2 + min(e for e in exits if e < _NEVER)
    by_cost = []
    for piece, after in _pieces(entry):
        if INSERT * (len(piece) - n) > limit:
            break
        least = max(INSERT * (len(piece) - n), DELETE * (n - len(piece))) + exits[after]
        if least <= limit:
            by_cost.append((least, len(piece), piece, after))
    best = None
    for least, _, piece, after in sorted(by_cost):
        incumbent = best[0] if best else _NEVER - 1
        if least > incumbent:
            break
        got = aligned(kinds, piece, at_end, incumbent - exits[after] if best else _NEVER // 2)
        if got and got[0] < _NEVER:
            found = (got[0] + exits[after], got[1], after)
            best = min(best, found) if best else found
    return best or (_NEVER, "", entry)


class Repairer:
    """Cheapest audits of conversations, given by one byte a turn (``kind_of``)."""

    def __init__(self, block: int = BLOCK):
        self.block, self.memo = block, {}

    def _answer(self, codes: bytes, entry: int, exits: tuple[int, ...], at_end: bool) -> tuple[int, str, int]:
        floor = min(exits)
        key = (codes, entry, tuple(min(e - floor, _NEVER) if e < _NEVER else _NEVER for e in exits), at_end)
        if key not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            kinds = [(_INITIALS[c // 3], c % 3) for c in codes]
            self.memo[key] = cheapest(kinds, entry, key[2], at_end)
        cost, audit, after = self.memo[key]
        return (cost + floor if cost < _NEVER else _NEVER), audit, after

    def audit(self, codes: bytes) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits."""
        exits, at_end, answers = (0, _NEVER, _NEVER, 0), True, []
        for low in range((max(len(codes), 1) - 1) // self.block * self.block, -1, -self.block):
            part = bytes(codes[low:low + self.block])
            entries = range(4) if low else (_START,)
            found = [self._answer(part, e, exits, at_end) for e in entries]
            answers.append(found)
            exits, at_end = tuple(f[0] for f in found), False
        cost, at, audit = answers[-1][0][0], _START, []
        for found in reversed(answers):
            _, piece, at = found[at]
            audit.append(piece)
        return cost, "".join(audit)


def kind_of(initial: str, fault: int) -> int:
    """The byte that stands for a turn: its role's initial, and 0, must go (1) or truncated (2)."""
    place = _INITIALS.find(initial) if initial and initial != "?" else 3
    return 3 * (place if place >= 0 else 3) + fault


# -- Spark ----------------------------------------------------------------------------------------------------------


def _in_reading_order(turns: DataFrame) -> DataFrame:
    """Rows dealt and sorted by conversation: what is lost, then every turn's kind, then every turn's text."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = turns.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    same = Window.partitionBy("conv_id", "lost", "role", "text").orderBy("place")
    rows = rows.withColumn("again", F.row_number().over(same) > 1)
    filled = F.rtrim("text", F.lit(_WHITE))
    fault = F.when(filled == "", 1).when(F.col("again"), 2).when(~F.substring(filled, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    steps = F.when(F.col("lost"), F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2)))
    rows = rows.select("conv_id", "turn", "place", "role", "text", fault.cast("int").alias("fault"), F.explode(steps).alias("step"))
    text = F.col("step") == 2
    rows = rows.select("conv_id", "step", "place", F.when(~text, F.col("turn")).alias("turn"), "fault",
                       F.when(text, F.col("role")).otherwise(F.substring("role", 1, 1)).alias("role"), F.when(text, F.col("text")).alias("text"))
    return rows.sortWithinPartitions("conv_id", "step", "place")


class _Conversation:
    """What a task knows of the conversation that it reads."""

    def __init__(self, conv):
        self.conv, self.codes, self.faults = conv, bytearray(), [0, 0, 0, 0]
        self.first_turn = self.last_turn = None
        self.turns = self.illegal = 0
        self.before = None
        self.cost, self.audit, self.at, self.grammar = 0, None, 0, _START
        self.hash, self.places = hashlib.sha256(), 0

    def kind(self, turn, initial, fault):
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        self.codes.append(kind_of(initial, (_FREE, _MUST_GO, _MUST_GO, _TRUNCATED)[fault]))

    def solve(self, repairer):
        if self.audit is None:
            self.cost, self.audit = repairer.audit(self.codes)

    def _next_role(self):
        return "assistant" if self.grammar == _AFTER_U else "user"

    def _put(self, edit, role, text):
        if self.places:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.places += 1
        return (self.conv, self.places, edit, role, text)

    def _move(self, initial):
        self.grammar = _AFTER_S if initial == "s" else _AFTER_U if initial == "u" else _AFTER_A

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role = self._next_role()
            self._move(role[0])
            yield self._put("I", role, "")

    def turn(self, role, text):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            role = self._next_role() if edit == "R" else role
            self._move(role[0])
            yield self._put(edit, role, text)

    def summary(self):
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, self.audit, self.hash.hexdigest())


def _streamed(turns: DataFrame, schema: str, texts: bool) -> DataFrame:
    executors_ready(turns.sparkSession)
    rows = _in_reading_order(turns)
    conv_kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        repairer, now, kind = Repairer(), None, None
        for batch in batches:
            out, kind = [], batch.schema.field(0).type
            for conv, step, _, turn, fault, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != conv:
                    out += ended(now, repairer)
                    now = _Conversation(conv)
                if step == 1:
                    now.kind(turn, role, fault)
                elif step == 2:
                    now.solve(repairer)
                    put = list(now.turn(role, text))
                    out += put if texts else []
            yield from packed(out, kind)
        if now is not None:
            yield from packed(ended(now, repairer), kind)

    def ended(now, repairer):
        if now is None:
            return []
        now.solve(repairer)
        left = list(now.inserted())
        return left if texts else [now.summary()]

    def packed(out, kind):
        if out:
            whole = {"string": pa.string(), "long": pa.int64()}
            fields = [("conv_id", kind)] + [(n, whole[t]) for n, t in (f.split() for f in schema.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)],
                                             names=[n for n, _ in fields])

    return rows.mapInArrow(run, f"conv_id {conv_kind}, {schema}")


def _named(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    lost = F.col("lost") if "lost" in turns.columns else F.lit(False).alias("lost")
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, lost)


def repair_audits(turns: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text and, if given, lost): gaps, blank, duplicate, truncated,
    illegal, cost, audit and the digest of the repaired turns."""
    return _streamed(_named(turns), "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                    "audit string, repaired_sha256 string", False)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 1, edit, role, text) of every turn that stays."""
    return _streamed(_named(turns), "place long, edit string, role string, text string", True)
