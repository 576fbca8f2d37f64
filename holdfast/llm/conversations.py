"""Conversations repaired at the least cost, each decided by one integer.

The role initials of a repaired conversation read ``(s?(ua)+)?``: an optional system message,
then user and assistant in turn. Per row the choices are edges from one state of that
language to another: keep it, delete it or give it another role, with messages inserted
before it. An edge weighs its cost in high digits and, in a slot of fixed width for its row,
the letters of its edits, filled with zeros at the end. No slot's letters begin another's
(a row's own letter ends them), so comparing the numbers compares cost first and then the
whole audit strings in ASCII order: a shortest path over plain integers decides everything.

Rows stream through sorted by conversation and turn. Whenever all states' best paths pass
through one state, everything before it is decided, written out and taken off the numbers,
so memory does not grow with a conversation, but for its audit string and 16 bytes for each
of its distinct messages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# The digits stand in the letters' ASCII order; zero fills a slot's end.
DIGIT = {letter: 1 + k for k, letter in enumerate(sorted(COSTS))}
DIGIT_BITS = 3
# Two insertions and the row's own letter.
SLOT = 3
SLOT_BITS = SLOT * DIGIT_BITS

BLANKS = " \t\n\v\f\r"
# States: nothing yet, after s, after u, after a. What each one takes, and where it leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ACCEPTED = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}


def _slot(letters: str) -> int:
    """Letters as digits of one slot, zeros behind them."""
    value = 0
    for k in range(SLOT):
        value = value << DIGIT_BITS | (DIGIT[letters[k]] if k < len(letters) else 0)
    return value


@dataclass(frozen=True)
class Edge:
    """A way from one state to another over one row; ``role`` is the row's new one, if any."""

    start: int
    end: int
    cost: int
    letters: str
    inserted: tuple[str, ...]
    role: str | None
    slot: int


def _insertions(state: int) -> Iterator[tuple[int, tuple[str, ...]]]:
    """(state, roles) after no, one and two insertions; only one role fits each time."""
    roles: tuple[str, ...] = ()
    yield state, roles
    for _ in range(SLOT - 1):
        ((initial, state),) = [(c, s) for c, s in STEPS[state].items() if c in ROLES]
        roles += (ROLES[initial],)
        yield state, roles


def _edges(initial: str, wrong: bool, truncated: bool) -> list[list[Edge]]:
    """Per end state the edges of a row, of two with the same ends only the lighter."""
    best: dict[tuple[int, int], Edge] = {}
    for start in STEPS:
        for state, roles in _insertions(start):
            ways = [(DELETE, state, None)]
            if not wrong:
                ways += [(KEEP, end, None) for c, end in STEPS[state].items() if c == initial]
                ways += [(REROLE, end, ROLES[c]) for c, end in STEPS[state].items() if c in ROLES]
            for letter, end, role in ways:
                letters = INSERT * len(roles) + letter
                cost = sum(COSTS[x] for x in letters) + (truncated and letter != DELETE) * TRUNCATED_COST
                edge = Edge(start, end, cost, letters, roles, role, _slot(letters))
                held = best.get((start, end))
                if held is None or (edge.cost, edge.slot) < (held.cost, held.slot):
                    best[start, end] = edge
    return [[e for e in best.values() if e.end == end] for end in STEPS]


EDGES = {
    (initial, wrong, truncated): _edges(initial, wrong, truncated)
    for initial in ("s", "u", "a", "")
    for wrong in (False, True)
    for truncated in (False, True)
}


def _endings() -> list[Edge]:
    """Per state the insertions that lead to an accepted one at the end."""
    found = []
    for start in STEPS:
        state, roles = next((s, r) for s, r in _insertions(start) if s in ACCEPTED)
        letters = INSERT * len(roles)
        found.append(Edge(start, state, sum(COSTS[x] for x in letters), letters, roles, None, _slot(letters)))
    return found


ENDINGS = _endings()
LEGAL_PAIRS = {"su", "ua", "au"}
# BEHIND[q][p]: by how much the rest may cost more from state q than from state p. From p one
# may insert what q lacks (2 each), and a system message kept from the start state costs 3 to
# delete from the others; after an assistant's all is allowed that is after a system message.
BEHIND = ((0, 0, 2, 0), (7, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))


@dataclass
class Repair:
    """One conversation, fed row by row in order. ``out`` takes the decided messages as
    (role, text, letter), a deleted one with role and text None."""

    conv_id: int | None
    check_rows: int = 256
    out: list = field(default_factory=list)
    gaps: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0

    def __post_init__(self):
        self.audit: list[str] = []
        self.sha = hashlib.sha256()
        self.written = 0
        self.seen: set[bytes] = set()
        self.turns: list = [None, None, 0]
        self.initial: str | None = None
        self.values: list[int | None] = [0, None, None, None]
        # Per undecided row (edge into each state, role, text).
        self.rows: list[tuple[list[Edge | None], str | None, str | None]] = []
        self.limit = self.check_rows

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            first, last, distinct = self.turns
            self.turns = [turn if first is None else first, turn, distinct + (turn != last)]
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL_PAIRS
        self.initial = initial
        said = text.rstrip(BLANKS)
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        blank, repeated = not said, digest in self.seen
        self.seen.add(digest)
        cut = not (blank or repeated) and said[-1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut
        wrong = blank or repeated
        self._step(EDGES[initial if initial in ("s", "u", "a") else "", wrong, cut], wrong, role, text)

    def _step(self, edges: list[list[Edge]], wrong: bool, role: str, text: str) -> None:
        shift = SLOT_BITS * (len(self.rows) + 1)
        values: list[int | None] = []
        ways: list[Edge | None] = []
        for into in edges:
            best = way = None
            for e in into:
                held = self.values[e.start]
                if held is not None:
                    value = (held << SLOT_BITS) + (e.cost << shift) + e.slot
                    if best is None or value < best:
                        best, way = value, e
            values.append(best)
            ways.append(way)
        # A state that another one undercuts by more than the rest could make up for goes.
        costs = [None if v is None else v >> shift for v in values]
        for p, cost in enumerate(costs):
            if cost is not None and any(c is not None and cost > c + BEHIND[q][p] for q, c in enumerate(costs)):
                values[p] = None
        self.values = values
        self.rows.append((ways, None if wrong else role, None if wrong else text))
        if len(self.rows) >= self.limit:
            self._decide()
            self.limit = max(self.check_rows, 2 * len(self.rows))

    def _decide(self) -> None:
        """Write out the rows before the last one that all best paths leave from one state."""
        alive = {s for s, v in enumerate(self.values) if v is not None}
        at = len(self.rows)
        while at and len(alive) > 1:
            at -= 1
            alive = {self.rows[at][0][s].start for s in alive}
        if not at:
            return
        left = len(self.rows) - at
        whole, digits = SLOT_BITS * len(self.rows), (1 << SLOT_BITS * left) - 1
        self._write(at, alive.pop())
        least = min(v >> whole for v in self.values if v is not None)
        self.values = [
            None if v is None else ((v >> whole) - least << SLOT_BITS * left) + (v & digits) for v in self.values
        ]

    def _write(self, count: int, state: int) -> None:
        """Write out the first ``count`` rows, on the best path to ``state``."""
        path = []
        for ways, _, _ in reversed(self.rows[:count]):
            path.append(ways[state])
            state = path[-1].start
        for edge, (_, role, text) in zip(reversed(path), self.rows):
            self._insert(edge)
            if edge.letters[-1] == DELETE:
                self.out.append((None, None, DELETE))
            else:
                self._message(edge.role or role, text, edge.letters[-1])
        del self.rows[:count]

    def _insert(self, edge: Edge) -> None:
        self.cost += edge.cost
        self.audit.append(edge.letters)
        for role in edge.inserted:
            self._message(role, "", INSERT)

    def _message(self, role: str, text: str, letter: str) -> None:
        said = f"{role}:{text}".encode("utf-8", "surrogatepass")
        self.sha.update(b"\n" + said if self.written else said)
        self.written += 1
        self.out.append((role, text, letter))

    def finish(self) -> None:
        shift = SLOT_BITS * (len(self.rows) + 1)
        ends = [
            ((v << SLOT_BITS) + (e.cost << shift) + e.slot, e) for v, e in zip(self.values, ENDINGS) if v is not None
        ]
        _, last = min(ends, key=lambda end: end[0])
        self._write(len(self.rows), last.start)
        self._insert(last)
        first, final, distinct = self.turns
        self.gaps = 0 if first is None else final - first + 1 - distinct

    def summary(self) -> tuple:
        counts = self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return self.conv_id, *counts, "".join(self.audit), self.sha.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Repair, bool]]:
    """(conversation, whether it is finished) after each of its rows, of sorted rows."""
    own: Repair | None = None
    for batch in words.row_slices(batches):
        columns = (batch.column(k).to_pylist() for k in range(4))
        for conv_id, turn, role, text in zip(*columns):
            if own is None or conv_id != own.conv_id:
                if own is not None:
                    own.finish()
                    yield own, True
                own = Repair(conv_id)
            if role is not None or text is not None:
                own.add(turn, " " if role is None else role, " " if text is None else text)
                yield own, False
    if own is not None:
        own.finish()
        yield own, True


SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
MESSAGES = "conv_id long, place long, role string, text string, edit string"
# Rows and characters of messages that are held for one batch.
OUT_ROWS = 2048


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    held: list[tuple] = []
    for own, finished in _stream(batches):
        own.out.clear()
        if finished:
            held.append(own.summary())
            if len(held) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in MESSAGES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    held: list[tuple] = []
    place = 0
    for own, finished in _stream(batches):
        for role, text, letter in own.out:
            held.append((own.conv_id, None if letter == DELETE else place, role, text, letter))
            place += letter != DELETE
        own.out.clear()
        place = 0 if finished else place
        if len(held) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _sorted(turns: DataFrame) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256).

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Rows are taken by
    turn, nulls first, and of the same turn by role and text. A null role or text is one
    space; a row with neither only names its conversation, so a table of such rows gives
    zeros and empty results. Rows with a null conv_id are one conversation. A row's first
    fault counts: blank, the same role and text as an earlier row, no ``.!?`` at its end.
    An initial other than s, u and a never fits, nor does an empty role. ``audit`` has the
    letters of the cheapest edits in order, of equally cheap ones the smallest in ASCII
    order; ``repaired_sha256`` is that of the repaired ``role:text`` lines.
    """
    return _sorted(turns).mapInArrow(_summaries, SUMMARY)


def repaired_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired conversations of
    :func:`repair_conversations`, message by message from place 0; deleted rows have nulls."""
    return _sorted(turns).mapInArrow(_messages, MESSAGES)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults set by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row (its
    conversation stays named), 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes
    it the user's. Nulls are one space."""
    space = F.lit(" ")
    place = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.pmod(F.crc32(place.cast("binary")), F.lit(20)).alias("fault"),
    )
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(times)).select(
        "conv_id",
        F.when(fault != 0, F.col("turn")).alias("turn"),
        F.when(fault == 4, "user").when(fault != 0, F.col("role")).alias("role"),
        F.when(fault != 0, text).alias("text"),
    )
