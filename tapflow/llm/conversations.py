"""Conversation structure repair: the cheapest edits that give roles `(s?(ua)+)?`, by a survivor-coalescence Viterbi.

Damage (planted faults, per row; null conv_id, turn, role or text count as one space): with h the crc32 of
`<conv_id>:<turn>` mod 20, 0 drops the row, 1 empties its text, 2 removes its `.`, `!` and `?`, 3 repeats it (same turn),
4 makes its role `user`. Then each conversation's rows are taken in order of turn (nulls first; ties by role, then text).
A row's first fault counts: blank (no character outside space and tab..CR), duplicate (role and text already seen in the
conversation), truncated (last such character not one of `.!?`). Spark's functions do all of this; a window over
(conversation, role, text) finds duplicates.

Edits: Keep (0), Rerole to user or assistant (1), Delete (2; the only edit of blank and duplicate rows), Insert an empty
user or assistant row anywhere (5); a truncated row that isn't deleted adds 5. The roles of the repaired conversation,
read as their initials, must match `(s?(ua)+)?` (states: start, after s, after u, after a; start and after a accept).
Among the cheapest edit sequences the one whose initials are least in ASCII wins.

The Viterbi runs in one pass over each conversation's rows, sorted within partitions after a shuffle by conversation.
Every state's survivor is a node of a backpointer tree; nodes live as long as a survivor's path refers to them (Python's
reference counts). Two paths into one state at equal cost are compared by their complete letters from the point where
they part. When all four survivors share an ancestor, the edits up to it are final: they are appended to the audit, their
rows hashed into the repaired text, and the tree is cut there, so memory holds only the unresolved suffix, not the
conversation. (At equal cost and row count, one path's letters can't be a prefix of another's, since inserts cost; so
the least path into a state stays least under any continuation.)

Defined cases: every original conv_id appears once (null is one conversation); a conversation without rows after damage
has zeros, an empty audit and the hash of the empty string; a role's initial is its first code point, so roles other
than system, user and assistant can only be reroled or deleted unless their initial is s, u or a. One conversation is
one task (its rows stream through it; memory is bounded by the unresolved suffix, time isn't split).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tapflow.llm import shared

DROP, EMPTY, UNPUNCTUATE, REPEAT, USER = 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACE = "[^\\x20\\x09-\\x0D]"
RESULT = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("gaps", T.LongType()), T.StructField("blank", T.LongType()),
    T.StructField("duplicate", T.LongType()), T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
])
#: Role-initial moves of the grammar `(s?(ua)+)?`: state -> initial -> next state.
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPT = (0, 3)
REPAIR_ROLE = {"u": "user", "a": "assistant"}


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, with `dropped` rows kept as markers: conv_id, turn, role, text, dropped, fault."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _spaced("role").alias("role"), _spaced("text").alias("text"),
        (F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20).alias("_h"),
    )
    h = F.col("_h")
    rows = rows.select(
        "conv_id", "turn", (h == DROP).alias("dropped"),
        F.when(h == USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(h == EMPTY, F.lit("")).when(h == UNPUNCTUATE, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(h == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    # One exchange by conversation serves the window below and the Viterbi's pass (`repair`).
    rows = rows.repartition("conv_id")
    order = [F.col("turn").asc_nulls_first(), "copy"]
    seen = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(*order)
    blank = ~F.regexp_like("text", F.lit(SPACE))
    duplicate = ~F.col("dropped") & (F.row_number().over(seen) > 1)
    truncated = ~F.regexp_like("text", F.lit("[.!?][\\x20\\x09-\\x0D]*\\z"))
    fault = F.when(blank, "blank").when(duplicate, "duplicate").when(truncated, "truncated")
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.when(~F.col("dropped"), fault).alias("fault"))


class _Node:
    """One edit on a survivor's path; `up` is None at the last emitted edit."""

    __slots__ = ("up", "letter", "line", "depth")

    def __init__(self, up: _Node | None, letter: str, line: str | None, depth: int):
        self.up, self.letter, self.line, self.depth = up, letter, line, depth


def _less(a: _Node, b: _Node) -> bool:
    """Whether path a's letters are less than b's, comparing from where they part."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.letter)
            a = a.up
        else:
            right.append(b.letter)
            b = b.up
    return "".join(reversed(left)) < "".join(reversed(right))


class _Repair:
    """The Viterbi of one conversation, fed row by row."""

    def __init__(self) -> None:
        self.root = _Node(None, "", None, 0)
        self.best: dict[int, tuple[int, _Node]] = self._closure({0: (0, self.root)})
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.lines = 0

    def _better(self, state: int, cost: int, node: _Node, into: dict[int, tuple[int, _Node]]) -> bool:
        old = into.get(state)
        if old is None or cost < old[0] or (cost == old[0] and _less(node, old[1])):
            into[state] = (cost, node)
            return True
        return False

    def _closure(self, best: dict[int, tuple[int, _Node]]) -> dict[int, tuple[int, _Node]]:
        changed = True
        while changed:
            changed = False
            for state, (cost, node) in list(best.items()):
                for initial, to in MOVES[state].items():
                    if initial in REPAIR_ROLE:
                        line = f"{REPAIR_ROLE[initial]}:"
                        changed |= self._better(to, cost + INSERT, _Node(node, "I", line, node.depth + 1), best)
        return best

    def feed(self, role: str, text: str, fault: str | None) -> None:
        penalty = TRUNCATED if fault == "truncated" else 0
        initial = role[:1]
        nxt: dict[int, tuple[int, _Node]] = {}
        for state, (cost, node) in self.best.items():
            self._better(state, cost + DELETE, _Node(node, "D", None, node.depth + 1), nxt)
            if fault in ("blank", "duplicate"):
                continue
            if initial in MOVES[state]:
                self._better(MOVES[state][initial], cost + KEEP + penalty, _Node(node, "K", f"{role}:{text}", node.depth + 1), nxt)
            for new, to in MOVES[state].items():
                if new in REPAIR_ROLE:
                    line = f"{REPAIR_ROLE[new]}:{text}"
                    self._better(to, cost + REROLE + penalty, _Node(node, "R", line, node.depth + 1), nxt)
        self.best = self._closure(nxt)
        self._coalesce()

    def _emit(self, top: _Node) -> None:
        path = []
        node = top
        while node.up is not None:
            path.append(node)
            node = node.up
        for step in reversed(path):
            self.audit.append(step.letter)
            if step.line is not None:
                self.digest.update((("\n" if self.lines else "") + step.line).encode("utf-8"))
                self.lines += 1
        top.up = None  # what lies above is final and emitted

    def _coalesce(self) -> None:
        nodes = [node for _, node in self.best.values()]
        depth = min(n.depth for n in nodes)
        nodes = [self._at(n, depth) for n in nodes]
        while any(n is not nodes[0] for n in nodes):
            nodes = [n.up for n in nodes]
            if any(n is None for n in nodes):
                return
        if nodes[0].up is not None:
            self._emit(nodes[0])

    @staticmethod
    def _at(node: _Node, depth: int) -> _Node:
        while node.depth > depth:
            node = node.up
        return node

    def finish(self) -> tuple[int, str, str]:
        ends = {s: v for s, v in self.best.items() if s in ACCEPT}
        cost, node = ends[0] if 0 in ends else ends[3]
        for other_cost, other in ends.values():
            if other_cost < cost or (other_cost == cost and _less(other, node)):
                cost, node = other_cost, other
        self._emit(node)
        return cost, "".join(self.audit), self.digest.hexdigest()


class _Counts:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.repair = conv_id, _Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.low = self.high = self.last_turn = self.last_initial = None

    def feed(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial = initial
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
            self.last_turn = turn
        self.repair.feed(role, text, fault)

    def row(self) -> dict:
        cost, audit, digest = self.repair.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])
    current: _Counts | None = None
    for batch in batches:
        done = []
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "dropped", "fault")]
        for conv_id, turn, role, text, dropped, fault in zip(*columns):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Counts(conv_id)
            if not dropped:
                current.feed(turn, role, text, fault)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.row()], schema=schema)


def repair(conversations: DataFrame) -> DataFrame:
    """One row per original conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = damaged(conversations)
    ordered = rows.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"
    )
    return shared.map_arrow(ordered, _stream, RESULT)
