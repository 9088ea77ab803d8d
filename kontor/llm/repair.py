"""Structure repair of conversations with the least edits, and an audit of them.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: a system
row at most, then user and assistant in turn. Rows are kept, given another role, deleted,
and empty rows are inserted; the cheapest sequence of edits wins, of equally cheap ones the
one whose letters come first in ASCII order.

A row moves the repaired conversation between four states (nothing yet, after s, after u,
after a). The dynamic program keeps, for each state, the least cost and the least letters
so far. Of two equally cheap ways to a state none is the beginning of the other (they hold
one letter for each row, and more insertions cost more), so keeping the least is enough.

Letters so far are persistent: a node is a letter behind a prefix, prefixes are shared, and
a step makes a node, not a copy. Nodes hold binary-lifting ancestors and a rolling hash of
all letters up to them. A tie is decided by the longest common prefix, found by lifting
both nodes while the hashes differ; prefixes of equal hash are verified letter by letter up
to a node that they share, so a collision changes nothing.

Every so often the prefix that all states share is settled: its edits are put out and its
nodes and rows dropped. So a task holds the rows of a conversation that are not settled
yet, whatever the conversation's length, and reads the others as a stream in Spark's order.
Duplicates are found by a window of Spark's, which spills, not by a table of the task.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType


KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
BLANK = " \t\n\v\f\r"
ENDS = ".!?"
# Pairs of neighbouring initials that a well-formed conversation may hold.
LEGAL = {"su", "ua", "au"}

# States of the repaired conversation, and where a row of an initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ROLE = {"u": "user", "a": "assistant"}
FINAL = (START, ASSISTANT)

# Rows that wait before the first attempt to settle some.
SETTLE = 256
MODULUS, RADIX = (1 << 61) - 1, 1_000_003

RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


class Node:
    """A letter behind a prefix of letters."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, prefix: Node | None, letter: str) -> None:
        self.letter = letter
        if prefix is None:
            self.depth, self.hash, self.up = 0, 0, []
            return
        self.depth = prefix.depth + 1
        self.hash = (prefix.hash * RADIX + ord(letter)) % MODULUS
        self.up = up = [prefix]  # the 2^k-th node before this one
        while len(up) <= len(up[-1].up):
            up.append(up[-1].up[len(up) - 1])

    def back(self, steps: int) -> Node:
        node = self
        while steps:
            k = min(steps.bit_length() - 1, len(node.up) - 1)
            node = node.up[k]
            steps -= 1 << k
        return node


def same(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth stand for the same letters."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:  # equal hashes prove nothing
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Whether the letters up to ``a`` come before those up to ``b``."""
    shorter = a.depth < b.depth
    depth = min(a.depth, b.depth)
    a, b = a.back(a.depth - depth), b.back(b.depth - depth)
    if same(a, b):
        return shorter
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and not same(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a.letter < b.letter


def shared(a: Node, b: Node) -> Node:
    """The last node that both go through."""
    depth = min(a.depth, b.depth)
    a, b = a.back(a.depth - depth), b.back(b.depth - depth)
    if a is b:
        return a
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and a.up[k] is not b.up[k]:
            a, b = a.up[k], b.up[k]
    return a.up[0]


@dataclass
class Row:
    role: str
    text: str
    turn: object = None
    repeated: bool = False
    fault: str | None = None

    def __post_init__(self) -> None:
        body = self.text.rstrip(BLANK)
        self.fault = (
            "blank" if not body else "duplicate" if self.repeated else "truncated" if body[-1] not in ENDS else None
        )


@dataclass
class Edit:
    letter: str
    role: str
    text: str
    cost: int
    row: Row | None = None


@dataclass
class Repair:
    """The dynamic program over the rows of one conversation."""

    cells: list = field(default_factory=lambda: [(0, Node(None, "")), None, None, None])
    waiting: deque = field(default_factory=deque)
    limit: int = SETTLE
    state: int = START

    @staticmethod
    def _offer(cells: list, state: int, cost: int, prefix: Node, letter: str) -> None:
        """A way to ``state``, kept if it is cheaper or, at the same cost, its letters come first."""
        own = cells[state]
        if own is not None and own[0] < cost:
            return
        node = Node(prefix, letter)
        if own is None or cost < own[0] or before(node, own[1]):
            cells[state] = (cost, node)

    def _insert(self) -> None:
        """Empty rows before the next row: one, or the two that lead from nothing to a pair."""
        for initial in ("u", "a", "u"):
            for state, to in NEXT[initial].items():
                if self.cells[state] is not None:
                    cost, node = self.cells[state]
                    self._offer(self.cells, to, cost + COST[INSERT], node, INSERT)
        # What can follow START or SYSTEM can follow ASSISTANT too, at the price of a deleted
        # system row at most. A state dearer by more than that leads to no cheapest way.
        if self.cells[ASSISTANT] is not None:
            for state, more in ((START, COST[DELETE]), (SYSTEM, 0)):
                if self.cells[state] is not None and self.cells[state][0] > self.cells[ASSISTANT][0] + more:
                    self.cells[state] = None

    def add(self, row: Row) -> Iterator[Edit]:
        """Take the next row; what is settled comes out."""
        self._insert()
        out: list = [None] * 4
        kept = row.fault not in ("blank", "duplicate")
        extra = TRUNCATED_COST if row.fault == "truncated" else 0
        for state, cell in enumerate(self.cells):
            if cell is None:
                continue
            cost, node = cell
            self._offer(out, state, cost + COST[DELETE], node, DELETE)
            if kept:
                for initial, moves in NEXT.items():
                    if state in moves:
                        if row.role[:1] == initial:
                            self._offer(out, moves[state], cost + extra, node, KEEP)
                        elif initial in ROLE:
                            self._offer(out, moves[state], cost + COST[REROLE] + extra, node, REROLE)
        self.cells = out
        self.waiting.append(row)
        if len(self.waiting) >= self.limit:
            yield from self._settle()

    def _settle(self) -> Iterator[Edit]:
        """Put out the edits that all states share, and drop their nodes."""
        live = [c[1] for c in self.cells if c is not None]
        base = live[0]
        for node in live[1:]:
            base = shared(base, node)
        letters = self._letters(base)
        copies = {id(base): Node(None, "")}

        def copy(node: Node) -> Node:
            path = []
            while id(node) not in copies:
                path.append(node)
                node = node.up[0]
            own = copies[id(node)]
            for n in reversed(path):
                own = copies[id(n)] = Node(own, n.letter)
            return own

        self.cells = [c and (c[0], copy(c[1])) for c in self.cells]
        yield from self._replay(letters)
        self.limit = max(SETTLE, 2 * len(self.waiting))

    @staticmethod
    def _letters(node: Node) -> list[str]:
        out = []
        while node.depth:
            out.append(node.letter)
            node = node.up[0]
        return out[::-1]

    def _replay(self, letters: list[str]) -> Iterator[Edit]:
        """The edits that letters stand for, on the rows that wait."""
        for letter in letters:
            wanted = "a" if self.state == USER else "u"
            if letter == INSERT:
                edit = Edit(letter, ROLE[wanted], "", COST[INSERT])
            else:
                row = self.waiting.popleft()
                extra = TRUNCATED_COST if row.fault == "truncated" and letter != DELETE else 0
                role = ROLE[wanted] if letter == REROLE else row.role
                edit = Edit(letter, role, row.text, COST[letter] + extra, row)
            if letter != DELETE:
                self.state = NEXT[edit.role[:1]][self.state]
            yield edit

    def end(self) -> Iterator[Edit]:
        """No more rows: the edits that are left."""
        self._insert()
        best = None
        for state in FINAL:
            cell = self.cells[state]
            if cell and (best is None or cell[0] < best[0] or (cell[0] == best[0] and before(cell[1], best[1]))):
                best = cell
        yield from self._replay(self._letters(best[1]))


def edits(rows: Iterator[Row]) -> Iterator[Edit]:
    """The cheapest edits of a conversation's rows, in order."""
    program = Repair()
    for row in rows:
        yield from program.add(row)
    yield from program.end()


def audit(rows: Iterator[Row]) -> dict:
    """What ``audits`` returns of a conversation."""
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    illegal, turns, low, high, last_turn, last = 0, 0, None, None, None, None

    def counted() -> Iterator[Row]:
        nonlocal illegal, turns, low, high, last_turn, last
        for row in rows:
            if row.fault:
                faults[row.fault] += 1
            illegal += last is not None and last + row.role[:1] not in LEGAL
            last = row.role[:1]
            if row.turn is not None and row.turn != last_turn:  # turns come in order
                turns, last_turn, high = turns + 1, row.turn, row.turn
                low = row.turn if low is None else low
            yield row

    cost, letters, digest, first = 0, [], hashlib.sha256(), True
    for edit in edits(counted()):
        cost += edit.cost
        letters.append(edit.letter)
        if edit.letter != DELETE:
            digest.update(("" if first else "\n").encode() + f"{edit.role}:{edit.text}".encode())
            first = False
    gaps = int(high - low + 1 - turns) if turns else 0
    return {
        "gaps": gaps, **faults, "illegal": illegal, "cost": cost,
        "audit": "".join(letters), "repaired_sha256": digest.hexdigest(),
    }


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, turn, role, text, repeated, gone) of each row, few at a time as objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*[part.column(i).to_pylist() for i in range(6)])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[Row]]]:
    """(conversation, its rows as a stream), in the order of the batches."""
    rows = _streams(batches)
    ahead = next(rows, None)

    def own(key: object) -> Iterator[Row]:
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            _, turn, role, text, repeated, gone = ahead
            if not gone:
                yield Row(role, text, turn, repeated)
            ahead = next(rows, None)

    while ahead is not None:
        key = ahead[0]
        stream = own(key)
        yield key, stream
        for _ in stream:  # whatever the reader left
            pass


def _prepared(df: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """Rows in the order of their conversations, repeats marked, one shuffle for both."""
    blank = F.lit(" ")
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`"), blank).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    ).withColumn("of_text", F.sha2("text", 256))
    order = [F.col("turn").asc_nulls_first(), "gone"]
    alike = Window.partitionBy("conv", "gone", "role", "of_text").orderBy(*order)
    marked = rows.repartition("conv").withColumn("repeated", F.row_number().over(alike) > 1)
    # Of equal rows of a turn the one that is no repeat comes first.
    ordered = marked.sortWithinPartitions(F.col("conv").asc_nulls_first(), *order, "role", "text", "repeated")
    return ordered.select("conv", "turn", "role", "text", "repeated", "gone")


def _per_conversation(rows: DataFrame, schema: StructType, fn: Callable[[object, Iterator[Row]], Iterator[dict]]) -> DataFrame:
    target = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        chars = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: [r[n] for r in held] for n in target.names}, schema=target)

        for key, stream in _grouped(batches):
            for row in fn(key, stream):
                held.append(row)
                chars += 64 + sum(len(v) for v in row.values() if isinstance(v, str))
                if chars >= 1 << 22:
                    yield batch()
                    held, chars = [], 0
        if held:
            yield batch()

    return rows.mapInArrow(work, schema)


def audits(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    gone: Column | None = None,
) -> DataFrame:
    """One row for each conversation: its id, gaps (turns missing between the least and the
    greatest), blank, duplicate and truncated rows (the first fault of a row counts; a
    duplicate has role and text of a row before it), illegal neighbours of roles, cost and
    letters of the cheapest edits, and the SHA-256 of the repaired rows.

    Rows are taken by turn, nulls first, rows of one turn by role and text. Null roles and
    texts count as one space (a blank row), null turns don't count for gaps, rows without
    conversation are one conversation. Where ``gone`` is true a row only says that its
    conversation exists: one without other rows gets zeros, no letters and the hash of the
    empty text. Other columns are not read. No rows give no rows.
    """
    own = df.schema[conv]
    schema = StructType([StructField("conv", own.dataType), *StructType.fromDDL(RESULT).fields])
    rows = _prepared(df, conv, turn, role, text, gone)
    return _per_conversation(rows, schema, lambda key, rows: iter([{"conv": key, **audit(rows)}])).withColumnRenamed(
        "conv", conv
    )


def repaired(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations, a row for each that stands: id, place (from 0), turn of
    the row it came from (null for an inserted one), role, text, edit (K, R or I). Null
    ids, turns, roles and texts as in ``audits``; no rows give no rows."""
    schema = (
        StructType().add("conv", df.schema[conv].dataType).add("place", "long").add("turn", df.schema[turn].dataType)
        .add("role", "string").add("text", "string").add("edit", "string")
    )

    def one(key: object, rows: Iterator[Row]) -> Iterator[dict]:
        place = 0
        for e in edits(rows):
            if e.letter != DELETE:
                yield {
                    "conv": key, "place": place, "turn": e.row.turn if e.row else None,
                    "role": e.role, "text": e.text, "edit": e.letter,
                }
                place += 1

    out = _per_conversation(_prepared(df, conv, turn, role, text, None), schema, one)
    return out.withColumnsRenamed({"conv": conv, "turn": turn, "role": role, "text": text})
