"""Operator 12, conversation structure repair: a generalised LR parse with weighted edits.

The roles of a conversation (their initials) must read ``(s?(ua)+)?``. Its LR
automaton is built from the grammar below. The parser keeps one stack top per
automaton state; every row may be deleted, kept (shifted) or given another role
(shifted as that role), and empty turns may be inserted (shifted) anywhere. A
top carries the cost and the audit, the initials of the edits that led to it,
and links to the top below it and to the top before the row. Equal tops merge:
the one with the least (cost, audit) stays. In this grammar a state fixes the
stack below it, so tops that merge have the same future.

Audits are compared without building them: after each row the tops that remain
are numbered in the order of their audits, and a new audit is compared as the
number of the top it extends, then the edits of one row. Every audit of the same
number of rows ends in the edit of a row, so none is the beginning of another.
A top more than ``SLACK`` dearer than the cheapest can never win: three
insertions and one deletion bring the cheapest to any state's future.

Spark deals the rows out by conversation and sorts them on disk; a conversation
is then streamed row by row. What all tops agree on is written out (hash, audit,
turns) and forgotten, so a task holds the undecided rows, not the conversation
(a run of rows of one role has two readings that cost alike: its texts are held
to the end of the run). One conversation stays in one task: its digest is a serial hash of all its turns.

Defined cases: rows of a conversation come by turn, nulls first, then by role
and text; a null conversation id is a conversation of its own; a null role or
text counts as one space; a role that is empty or has another initial fits no
place and must be deleted or changed; rows that repeat role and text are
duplicates; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from landfall.llm.common import slices, table

GRAMMAR = {"S": ("", "T"), "T": ("ua", "sua", "Tua")}
ROLES = {"u": "user", "a": "assistant"}   # what a row may become, and what may be inserted
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
SLACK = 3 * INSERT + DELETE
BATCH_BYTES = 8 << 20

BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


class Automaton:
    """LR states of a grammar of one-letter symbols: shifts, completed rules, and whether the start rule is complete."""

    def __init__(self, grammar: dict, start: str = "S"):
        def closed(items) -> frozenset:
            items = set(items)
            todo = list(items)
            while todo:
                _, body, dot = todo.pop()
                for rule in grammar.get(body[dot:dot + 1], ()):
                    item = (body[dot], rule, 0)
                    if item not in items:
                        items.add(item)
                        todo.append(item)
            return frozenset(items)

        states = [closed((start, body, 0) for body in grammar[start])]
        self.go: list[dict] = []
        self.complete: list[list] = []
        self.accepts: list[bool] = []
        for state in states:  # grows
            go: dict = {}
            for symbol in sorted({body[dot] for _, body, dot in state if dot < len(body)}):
                target = closed((head, body, dot + 1) for head, body, dot in state if body[dot:dot + 1] == symbol)
                if target not in states:
                    states.append(target)
                go[symbol] = states.index(target)
            whole = [(head, len(body)) for head, body, dot in state if dot == len(body)]
            self.go.append(go)
            self.complete.append([rule for rule in whole if rule[0] != start])
            self.accepts.append(any(head == start for head, _ in whole))


class Top:
    """A stack top: its state, the top below, and how it was reached from the tops before the row."""

    __slots__ = ("state", "below", "cost", "rank", "edits", "turns", "before")

    def __init__(self, state, below, cost=0, rank=0, edits="", turns=(), before=None):
        self.state, self.below = state, below
        self.cost, self.rank, self.edits, self.turns, self.before = cost, rank, edits, turns, before

    def key(self):
        return self.cost, self.rank, self.edits


class Parser:
    """Rows of one conversation go in by ``row``; ``end`` finishes it. ``write`` gets the decided edits and turns."""

    automaton = Automaton(GRAMMAR)

    def __init__(self, write):
        self.write = write
        self.tops = {0: Top(0, None)}
        self.undecided, self.look_at = 0, 64

    def _shift(self, top: Top, symbol: str) -> "tuple[int, Top] | None":
        """State and stack below after ``symbol`` and all reductions it completes."""
        state = self.automaton.go[top.state].get(symbol)
        if state is None or symbol in GRAMMAR:  # a role's initial may be the name of a rule
            return None
        below = top
        while self.automaton.complete[state]:
            (head, length), = self.automaton.complete[state]  # one rule: the automaton has no conflicts there
            for _ in range(length - 1):
                below = below.below
            state = self.automaton.go[below.state][head]
        return state, below

    def _with_insertions(self) -> dict:
        """The tops before the next row, empty turns inserted wherever that reaches a state more cheaply."""
        reached = {s: Top(s, t.below, t.cost, t.rank, "", (), t) for s, t in self.tops.items()}
        todo = list(reached.values())
        while todo:
            top = todo.pop()
            for symbol, role in ROLES.items():
                after = self._shift(top, symbol)
                if after:
                    self._offer(reached, after, top, INSERT, "I", (role, ""), todo)
        return reached

    @staticmethod
    def _offer(found: dict, after: tuple, top: Top, cost: int, edit: str, turn: "tuple | None", todo: "list | None" = None) -> None:
        state, below = after
        old = found.get(state)
        key = (top.cost + cost, top.rank, top.edits + edit)
        if old is None or key < old.key():
            found[state] = new = Top(state, below, *key, top.turns + (turn,) if turn else top.turns, top.before)
            if todo is not None:
                todo.append(new)

    def row(self, role: str, text: str, fault: "str | None") -> None:
        found: dict = {}
        extra = TRUNCATED if fault == CUT else 0
        for top in self._with_insertions().values():
            self._offer(found, (top.state, top.below), top, DELETE, "D", None)
            if fault in (BLANK, DUPLICATE):
                continue
            after = self._shift(top, role[:1])
            if after:
                self._offer(found, after, top, extra, "K", (role, text))
            for symbol, other in ROLES.items():
                after = self._shift(top, symbol)
                if after:
                    self._offer(found, after, top, REROLE + extra, "R", (other, text))
        least = min(top.cost for top in found.values())
        order = sorted((t for t in found.values() if t.cost <= least + SLACK), key=lambda t: (t.rank, t.edits))
        for rank, top in enumerate(order):
            top.rank = rank
        self.tops = {top.state: top for top in order}
        self.undecided += 1
        if self.undecided >= self.look_at:
            self._decide()

    def _decide(self) -> None:
        """Write what all tops have in common."""
        first, *others = self.tops.values()
        chain = self._chain(first)
        place = {id(top): i for i, top in enumerate(chain)}
        shared = 0  # of the chain, newest first, from here on
        for top in others:
            while top is not None and id(top) not in place:
                top = top.before
            shared = max(shared, len(chain) if top is None else place[id(top)])
        if not others:
            shared = 0
        for top in reversed(chain[shared:]):
            self._tell(top)
        if shared < len(chain):
            chain[shared].before = None
        self.undecided = min(shared, len(chain))
        self.look_at = max(64, 2 * self.undecided)

    @staticmethod
    def _chain(top: "Top | None") -> list:
        """The tops that hold edits not yet written, newest first."""
        chain = []
        while top is not None:
            chain.append(top)
            top = top.before
        return chain

    def _tell(self, top: Top) -> None:
        if top.edits:
            self.write(top.edits, top.turns)
            top.edits, top.turns = "", ()

    def end(self) -> int:
        """Finish and return the least cost."""
        best = min((t for t in self._with_insertions().values() if self.automaton.accepts[t.state]), key=Top.key)
        for top in reversed(self._chain(best)):
            self._tell(top)
        self.tops = {0: Top(0, None)}
        return best.cost


def _crc_key(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with defined damage: conv_id, turn, role, text, gone (the row is dropped).

    The damage of a row is crc32(conv_id:turn) mod 20, a null being one space:
    0 drops it, 1 empties its text, 2 takes out full stops, exclamation and
    question marks, 3 repeats it, 4 makes its role user.
    """
    kind = F.crc32(F.concat(_crc_key(F.col("conv_id")), F.lit(":"), _crc_key(F.col("turn")))) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"))
    repeats = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(repeats).alias("copy")).drop("copy")


def faulty(rows: DataFrame) -> DataFrame:
    """The rows with their first fault, dealt out by conversation and in order within each."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                       gone.alias("gone")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")  # already together: no further shuffle
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT))
    return (rows.withColumn("fault", fault)
            .sortWithinPartitions("conv_id", "gone", "turn", "role", "text", F.col("fault") == DUPLICATE))


class _Conversation:
    """The running summary of one conversation."""

    def __init__(self, conv_id, turns: "list | None"):
        self.conv_id, self.kept = conv_id, turns
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.illegal = self.n_turns = self.position = 0
        self.first = self.last = self.initial = None
        self.audit, self.digest, self.begun = [], hashlib.sha256(), False
        self.parser = Parser(self.write)

    def write(self, edits: str, turns: tuple) -> None:
        self.audit.append(edits)
        for role, text in turns:
            self.digest.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
            self.begun = True
            if self.kept is not None:
                self.kept.append((self.conv_id, self.position, role, text))
            self.position += 1

    def row(self, turn, role: str, text: str, fault: "str | None") -> None:
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.n_turns += 1
        if fault:
            self.faults[fault] += 1
        self.parser.row(role, text, fault)

    def summary(self) -> tuple:
        cost = self.parser.end()
        gaps = self.last - self.first + 1 - self.n_turns if self.n_turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.digest.hexdigest())


def _repair(batches: Iterator[pa.RecordBatch], schema: pa.Schema, as_turns: bool) -> Iterator[pa.RecordBatch]:
    """Summaries (or repaired turns) of conversations whose rows arrive together and in order."""
    out: list = []
    now = None

    def finished():
        row = now.summary()
        if not as_turns:
            out.append(row)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema=schema)
        out.clear()
        return made

    for part in slices(batches, "text", BATCH_BYTES):
        for conv_id, gone, turn, role, text, fault in zip(*(part.column(c).to_pylist() for c in (
                "conv_id", "gone", "turn", "role", "text", "fault"))):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    finished()
                now = _Conversation(conv_id, out if as_turns else None)
            if not gone:
                now.row(turn, role, text, fault)
        if out:
            yield batch()
    if now is not None:
        finished()
    if out:
        yield batch()


def _parsed(rows: DataFrame, columns: str, as_turns: bool) -> DataFrame:
    empty = rows.sparkSession.createDataFrame([], f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {columns}")
    arrow = to_arrow_schema(empty.schema)
    return faulty(rows).mapInArrow(lambda it: _repair(it, arrow, as_turns), empty.schema)


def repair_summary(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, optionally gone): its faults, the cheapest repair and its digest."""
    return _parsed(rows, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                         "repaired_sha256 string", False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text."""
    return _parsed(rows, "position long, role string, text string", True)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation with its faults, its cheapest repair and the repaired text's digest."""
    return repair_summary(damaged(table(spark, sf_dir, "conversations")))
