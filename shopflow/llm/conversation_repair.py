"""Conversation repair: the cheapest edits that make a conversation's roles fit a grammar.

The grammar is ``(s?(ua)+)?`` over role initials: an optional system turn, then user and
assistant in turn.  It is parsed by a generalised LR parser: every edit (keep, rerole,
delete, insert) moves each stack top on, tops in equal LR states are merged by least
(cost, audit), and the stacks share what is below their tops.  The audit is the text of
edit initials D, I, K, R; of equally cheap ones the ASCII-least wins.  At most five tops live
at a time, one for each LR state that can shift or accept, and which moves lead to them
depends on the tops' relative costs and order only, so every such step is built once and
then looked up.

Two audits of equally many rows that end in a row's edit are never one another's prefix, so
the order of the tops' audits after a row is enough to compare all that follows: no audit is
compared as text, and a row costs the same however long its conversation is.

Rows come to one task sorted by (conversation, turn) and are read as a stream; each top
carries a running hash of its repaired text, so no text is held.  A conversation gives one row
and one hash over its whole text, hence one task reads it; what is kept for each of its
rows is one reference.  Whether a row's role and text occurred before is found beforehand by
hash over all tasks.

Rows: a null ``conv_id`` is a conversation of its own; null turns come first; rows of one turn
are ordered by role and text; a null role or text counts as one space; repeated rows
are duplicates.  Other columns are left out.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}

# The edits' costs.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}

# LR(0) tables of  C -> empty | B | s B,  B -> P | B P,  P -> u a.
SHIFT = {(0, "s"): 2, (0, "u"): 3, (1, "u"): 3, (2, "u"): 3, (3, "a"): 5, (4, "u"): 3}
GOTO = {(0, "P"): 6, (0, "B"): 1, (1, "P"): 7, (2, "P"): 6, (2, "B"): 4, (4, "P"): 7}
REDUCE = {5: ("P", 2), 6: ("B", 1), 7: ("B", 2)}
ACCEPT = {0, 1, 4}

#: A stack: (LR state, the stack below or None).  Stacks share their lower parts.
Stack = tuple
START: Stack = (0, None)


def shift(stack: Stack, token: str) -> Stack | None:
    """The stack after ``token`` and all reductions, or None if it cannot follow."""
    state = SHIFT.get((stack[0], token))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        left, n = REDUCE[stack[0]]
        for _ in range(n):
            stack = stack[1]
        stack = (GOTO[stack[0], left], stack)
    return stack


@dataclass(frozen=True)
class Move:
    """How a new top came about: from which top, by which inserted roles and which edit of the row."""

    parent: int
    inserted: str
    edit: str  # D, K, R; '' at the end
    token: str  # the row's role initial afterwards, '' if it is gone


@dataclass(frozen=True)
class Tops:
    """Live stack tops: (stack, cost above the least, place of its audit among the tops')."""

    tops: tuple[tuple[Stack, int, int], ...]


@dataclass(frozen=True)
class Step:
    to: Tops
    moves: tuple[Move, ...]
    cost: int  # added to the least cost


def _inserted(tops: Tops) -> dict[int, tuple]:
    """Every stack that inserts alone reach, by its top: (cost, (place, edits), stack, parent, inserted)."""
    best: dict[int, tuple] = {}
    agenda = [(cost, (place, ""), stack, i, "") for i, (stack, cost, place) in enumerate(tops.tops)]
    while agenda:
        agenda.sort(key=lambda x: x[:2])
        cost, audit, stack, parent, text = agenda.pop(0)
        if stack[0] in best:  # merged: the first is the least
            continue
        best[stack[0]] = (cost, audit, stack, parent, text)
        for token in ROLES:
            after = shift(stack, token)
            if after is not None:
                agenda.append((cost + INSERT, (audit[0], audit[1] + "I"), after, parent, text + token))
    return best


def take_row(tops: Tops, initial: str, must_go: bool, cut_short: bool) -> Step:
    """All edits of one row on all tops, merged."""
    best: dict[int, tuple] = {}

    def offer(cost, audit, stack, move):
        if stack[0] not in best or (cost, audit) < best[stack[0]][:2]:
            best[stack[0]] = (cost, audit, stack, move)

    for cost, (place, edits), stack, parent, text in _inserted(tops).values():
        offer(cost + DELETE, (place, edits + "D"), stack, Move(parent, text, "D", ""))
        if must_go:
            continue
        for edit, price, tokens in (("K", KEEP, initial), ("R", REROLE, "ua")):
            for token in tokens:
                after = shift(stack, token)
                if after is not None:
                    offer(cost + price + CUT_SHORT * cut_short, (place, edits + edit), after, Move(parent, text, edit, token))
    least = min(x[0] for x in best.values())
    places = {audit: i for i, audit in enumerate(sorted({x[1] for x in best.values()}))}
    found = sorted(best.values(), key=lambda x: x[2][0])
    return Step(Tops(tuple((stack, cost - least, places[audit]) for cost, audit, stack, _ in found)), tuple(m for *_, m in found), least)


def finish(tops: Tops) -> tuple[int, Move]:
    """(cost above the least, last move) of the cheapest way to end here."""
    ends = [x for state, x in _inserted(tops).items() if state in ACCEPT]
    cost, _, _, parent, text = min(ends, key=lambda x: x[:2])
    return cost, Move(parent, text, "", "")


class Steps:
    """Steps and ends, each built once; sets of tops are known by number, START alone by 0."""

    def __init__(self):
        self.tops = [Tops(((START, 0, 0),))]
        self.number = {self.tops[0]: 0}
        self.rows: dict[tuple, tuple[int, tuple[Move, ...], int]] = {}
        self.ends: dict[int, tuple[int, Move]] = {}

    def row(self, at: int, symbol: tuple[str, bool, bool]) -> tuple[int, tuple[Move, ...], int]:
        found = self.rows.get((at, symbol))
        if found is None:
            step = take_row(self.tops[at], *symbol)
            if step.to not in self.number:
                self.number[step.to] = len(self.tops)
                self.tops.append(step.to)
            found = self.rows[at, symbol] = (self.number[step.to], step.moves, step.cost)
        return found

    def end(self, at: int) -> tuple[int, Move]:
        if at not in self.ends:
            self.ends[at] = finish(self.tops[at])
        return self.ends[at]


class Conversation:
    """One conversation's rows as they pass by."""

    def __init__(self, conv_id, steps: Steps):
        self.conv_id, self.steps = conv_id, steps
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None  # role initial of the row before
        self.at, self.cost = 0, 0
        self.hashes = [hashlib.sha256()]
        self.history: list[tuple[Move, ...]] = []

    def _written(self, move: Move, row: str | None):
        """The running hash after a move."""
        parts = [ROLES[t] + ":" for t in move.inserted] + ([] if row is None else [row])
        got = self.hashes[move.parent]
        if parts:
            empty = self.steps.tops[self.at].tops[move.parent][0] == START
            got = got.copy()
            got.update((("" if empty else "\n") + "\n".join(parts)).encode())
        return got

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial
        if turn is not None:
            if self.turns == 0:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        end = text.rstrip(BLANKS)
        blank, duplicate = not end, bool(end) and seen
        cut_short = bool(end) and not seen and not end.endswith(STOPS)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut_short
        to, moves, cost = self.steps.row(self.at, (initial if initial in ("s", "u", "a") else "", blank or duplicate, cut_short))
        self.hashes = [self._written(m, None if m.edit == "D" else f"{role if m.edit == 'K' else ROLES[m.token]}:{text}") for m in moves]
        self.at, self.cost = to, self.cost + cost
        self.history.append(moves)

    def result(self) -> tuple:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        more, move = self.steps.end(self.at)
        digest = self._written(move, None).hexdigest()
        audit = ["I" * len(move.inserted)]
        for moves in reversed(self.history):
            move = moves[move.parent]
            audit.append("I" * len(move.inserted) + move.edit)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + more, "".join(reversed(audit)), digest)


def _parse(schema: pa.Schema):
    """Sorted (conv_id, turn, role, text, copies, seen) -> one row for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, out = Steps(), None, []
        for batch in batches:
            for conv_id, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.result())
                    now = Conversation(conv_id, steps)
                for k in range(copies):
                    now.add(turn, role, text, seen or k > 0)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if now is not None:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(now.result()), schema)], schema=schema)

    return run


def _ordered(turns: DataFrame, copies: Column | None) -> DataFrame:
    """(conv_id, turn, role, text, copies, seen): nulls filled in; ``seen``: an earlier row says the same in the same role."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("int").alias("copies"))
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256), F.col("copies") > 0).orderBy(F.asc_nulls_first("turn"))
    return rows.withColumn("seen", F.row_number().over(same) > 1)


def repair_conversations(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``turns`` has conv_id, turn, role, text.  ``copies`` says how often a row stands in its
    conversation (default 1); a conversation all of whose rows have 0 is empty.
    """
    schema = T.StructType().add(turns.schema["conv_id"])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    rows = _ordered(turns, copies).repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return rows.mapInArrow(_parse(to_arrow_schema(schema)), schema)


def repaired_turns(turns: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired conversations' rows by their audits, numbered from 1."""
    rows = _ordered(turns, None)
    by_turn = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = rows.select("conv_id", F.row_number().over(by_turn).alias("row"), "role", "text")
    edits = verdicts.select("conv_id", "audit", F.posexplode(F.split("audit", "(?!^)(?=.)")).alias("pos", "edit")).where("edit <> ''")
    upto = Window.partitionBy("conv_id").orderBy("pos")
    system = F.length(F.regexp_replace("audit", "D", "")) % 2  # user and assistant come in pairs
    edits = edits.select(F.col("conv_id").alias("id"), "edit", F.sum((F.col("edit") != "I").cast("int")).over(upto).alias("at"),
                         F.sum((F.col("edit") != "D").cast("int")).over(upto).alias("place"), system.alias("system"))
    both = edits.where("edit <> 'D'").join(numbered, edits["id"].eqNullSafe(numbered["conv_id"]) & (F.col("at") == F.col("row"))
                                           & (F.col("edit") != "I"), "left")
    turn = F.when((F.col("place") - F.col("system")) % 2 == 1, "user").otherwise("assistant")
    return both.select(F.col("id").alias("conv_id"), "place", F.when(F.col("edit") == "K", F.col("role")).otherwise(turn).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"), "edit")
