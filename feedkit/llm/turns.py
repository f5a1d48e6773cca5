"""Repair of conversations: the cheapest edits that make their roles alternate.

Repaired roles read ``(s?(ua)+)?`` by their initials: an optional system turn, then user and assistant in turn. For
each length there is one such string, so a conversation is aligned to the string of every feasible length as by Wagner
and Fischer: keep or re-role a turn, delete it, insert an empty one. Strings that end alike share a table, counted from the
end. Ukkonen's band around the diagonal holds all cells through which an alignment no dearer than the best one known can
pass; a first narrow band finds that incumbent. Of the cheapest alignments of all lengths the least audit, as ASCII
text, is taken.

At scale: one shuffle by conversation. Turns come sorted, and a task holds a few bytes a turn; lines of a long
conversation wait in a file of the task's own. Long conversations are aligned in blocks of ``BLOCK`` turns: for each
role before and after a block its best alignment, and these are joined as costs add and audits follow each other. The
audit and the hash of a conversation's lines go from its first turn to its last, so a conversation stays in one task,
as a stream.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise
from tempfile import SpooledTemporaryFile
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Costs of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns aligned together; cells beside the diagonal in the first band; bytes of lines held in memory.
BLOCK, NARROW, HELD = 256, 4, 16 << 20
WHITE, STOPS = " \t\n\v\f\r", ".!?"
LEGAL = {"su", "ua", "au"}
#: What the repaired turns so far end with: nothing, the system's, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
BLANK, DUPLICATE, CUT, NO_FAULT = range(4)


@dataclass
class Band:
    """A table from the end: the cost of aligning turns ``i``, ... to the last ``m`` signs of a string, for ``m`` near the diagonal."""

    low: list[int]
    cells: list[list[float]]

    def at(self, i: int, m: int) -> float:
        j = m - self.low[i]
        return self.cells[i][j] if 0 <= j < len(self.cells[i]) else math.inf


class Block:
    """Turns as (initial, fault) that are aligned together."""

    def __init__(self, turns: list[tuple[str, int]]):
        self.turns, n = turns, len(turns)
        self.free = [0] * (n + 1)  # turns from here on that need not be deleted
        for i in range(n - 1, -1, -1):
            self.free[i] = self.free[i + 1] + (turns[i][1] not in (BLANK, DUPLICATE))
        self.due = DELETE * (n - self.free[0])  # what every alignment pays
        self.bands: dict[str, Band] = {}

    def kept(self, i: int, sign: str) -> float:
        """The cost of turn ``i`` as ``sign``."""
        initial, fault = self.turns[i]
        if fault in (BLANK, DUPLICATE) or (sign == SYSTEM and initial != SYSTEM):
            return math.inf
        return (initial != sign) * REROLE + (fault == CUT) * TRUNCATED

    def band(self, last: str, below: int, above: int) -> Band:
        """The table of strings that end with ``last``, from ``below`` signs fewer than free turns to ``above`` more."""
        n = len(self.turns)
        low = [max(0, f - below - 1) for f in self.free]  # a system's turn that stays is none of the signs
        cells: list[list[float]] = [[] for _ in range(n + 1)]
        cells[n] = [INSERT * m for m in range(low[n], above + 1)]
        for i in range(n - 1, -1, -1):
            after, start = cells[i + 1], low[i + 1]
            odd, even = self.kept(i, last), self.kept(i, NEXT[last])
            row, before = cells[i], math.inf
            for m in range(low[i], self.free[i] + above + 1):
                j = m - start
                best = before + INSERT
                if 0 <= j < len(after) and after[j] + DELETE < best:
                    best = after[j] + DELETE
                if 0 < j <= len(after) and m:
                    same = after[j - 1] + (odd if m % 2 else even)
                    best = min(best, same)
                row.append(best)
                before = best
        return Band(low, cells)

    def with_system(self, last: str) -> list[list[float]]:
        """As the band's cells, for strings with the system's sign before them."""
        band, n = self.bands[last], len(self.turns)
        rows: list[list[float]] = [[math.inf] * len(r) for r in band.cells]
        for i in range(n - 1, -1, -1):
            keep = self.kept(i, SYSTEM)
            for j in range(len(rows[i])):
                m = band.low[i] + j
                k = m - band.low[i + 1]
                deleted = rows[i + 1][k] + DELETE if 0 <= k < len(rows[i + 1]) else math.inf
                rows[i][j] = min(deleted, keep + band.at(i + 1, m))
        return rows

    def walk(self, length: int, last: str, system: list[list[float]] | None) -> str:
        """The least of the cheapest audits for a string of ``length``, after the system's sign if ``system`` is its table."""
        band, n, i, m, out = self.bands[last], len(self.turns), 0, length, []

        def cost(i: int, m: int, first: bool) -> float:
            if not first:
                return band.at(i, m)
            j = m - band.low[i]
            return system[i][j] if 0 <= j < len(system[i]) else math.inf

        first = system is not None
        while i < n or m or first:
            now = cost(i, m, first)
            if i < n and cost(i + 1, m, first) + DELETE == now:
                out.append("D")
                i += 1
            elif not first and m and cost(i, m - 1, False) + INSERT == now:
                out.append("I")
                m -= 1
            else:
                sign = SYSTEM if first else last if m % 2 else NEXT[last]
                out.append("K" if self.turns[i][0] == sign else "R")
                i, m, first = i + 1, m if first else m - 1, False
        return "".join(out)

    def lengths(self, before: str, last: str) -> Iterator[tuple[int, bool, float]]:
        """Every length of band that leads from ``before`` to ``last``: signs, whether the system's comes first, cost."""
        band = self.bands[last]
        for j, cost in enumerate(band.cells[0]):
            m = band.low[0] + j
            if m and (m % 2 == 1) == (NEXT[before] == last):
                yield m, False, cost
            if m == 0 and before == last:
                yield 0, False, cost
        if before == NOTHING:
            for j, cost in enumerate(self.with_system(last)[0]):
                m = band.low[0] + j
                if m and m % 2 == (last == USER):
                    yield m, True, cost

    def best(self, before: str, last: str) -> float:
        return min((cost for _, _, cost in self.lengths(before, last)), default=math.inf)

    def aligned(self, steps: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, str]]:
        """For each step, from what the turns before end with to what these do, the least cost and audit; without those that cannot be."""
        n, out = len(self.turns), {}
        wide = [(a, b) for a, b in steps if b in (USER, ASSISTANT)]
        below = above = NARROW
        while wide:
            self.bands = {last: self.band(last, below, above) for last in {b for _, b in wide}}
            # an alignment of the incumbent's cost at most deletes or inserts no more than this, beside what must go
            spare = max(self.best(a, b) for a, b in wide) - self.due
            if spare == math.inf:
                below, above = 2 * below + n, 2 * above
                continue
            need = int(spare) // DELETE, int(spare) // INSERT
            if need[0] <= below and need[1] <= above:
                break
            below, above = max(below, need[0]), max(above, need[1])
        for before, last in steps:
            if last == NOTHING or (last == SYSTEM and before == SYSTEM):
                if before == last:
                    out[before, last] = DELETE * n, "D" * n
            elif last == SYSTEM:
                found = self._system_alone()
                if found and before == NOTHING:
                    out[before, last] = found
            else:
                options = list(self.lengths(before, last))
                least = min(cost for _, _, cost in options)
                tables = self.with_system(last)
                out[before, last] = int(least), min(self.walk(m, last, tables if first else None) for m, first, cost in options if cost == least)
        return out

    def _system_alone(self) -> tuple[int, str] | None:
        """One system's turn kept, all others deleted."""
        n = len(self.turns)
        costs = [(DELETE * (n - 1) + int(self.kept(i, SYSTEM)), "D" * i + "K" + "D" * (n - 1 - i)) for i in range(n) if self.kept(i, SYSTEM) < math.inf]
        return min(costs, default=None)


ENDS = (NOTHING, SYSTEM, USER, ASSISTANT)


def align(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation's turns, given as (initial, fault)."""
    blocks = [turns[i : i + BLOCK] for i in range(0, len(turns), BLOCK)]
    reached: dict[str, tuple[int, str]] = {NOTHING: (0, "")}
    for k, block in enumerate(blocks):
        ends = (NOTHING, ASSISTANT) if k == len(blocks) - 1 else ENDS
        found = Block(block).aligned([(a, b) for a in reached for b in ends])
        after: dict[str, tuple[int, str]] = {}
        for (a, b), (cost, audit) in found.items():
            whole = reached[a][0] + cost, reached[a][1] + audit
            after[b] = min(after.get(b, whole), whole)
        reached = after
    return min(reached[end] for end in (NOTHING, ASSISTANT) if end in reached)


# ---------------------------------------------------------------- conversations


@dataclass
class Conversation:
    """What is known of a conversation as its turns pass by; their lines wait in ``lines``."""

    conv_id: object
    lines: IO[bytes] = field(default_factory=lambda: SpooledTemporaryFile(HELD))  # noqa: SIM115
    turns: list[tuple[str, int]] = field(default_factory=list)
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    low: int | None = None
    high: int | None = None
    distinct: int = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        said = text.rstrip(WHITE)
        fault = BLANK if not said else DUPLICATE if repeated else CUT if said[-1] not in STOPS else NO_FAULT
        self.counts[fault] += 1
        self.turns.append((role[:1], fault))
        pickle.dump((role, text), self.lines)
        if turn is not None and turn != self.high:  # turns come in order
            self.low, self.high, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.distinct if self.distinct else 0

    @property
    def illegal(self) -> int:
        return sum(a + b not in LEGAL for (a, _), (b, _) in pairwise(self.turns))

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of the turns that stay or are inserted."""
        self.lines.seek(0)
        end = NOTHING
        for edit in audit:
            if edit == "I":
                role, text = ROLES[NEXT[end]], ""
            else:
                role, text = pickle.load(self.lines)
                if edit == "D":
                    continue
                role = role if edit == "K" else ROLES[NEXT[end]]
            end = role[:1]
            yield edit, role, text


def prepared(turns: DataFrame, stays: Column | None = None) -> DataFrame:
    """Turns dealt by conversation and sorted, with ``repeated``: role and text came earlier. Null roles and texts are one space."""
    filled = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.lit(True) if stays is None else stays).alias("stays"),
    ).repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "stays", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    return filled.withColumn("repeated", again).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    now = None
    for batch in batches:
        for conv_id, turn, role, text, stays, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                    now.lines.close()
                now = Conversation(conv_id)
            if stays:
                now.add(turn, role, text, repeated)
    if now is not None:
        yield now
        now.lines.close()


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 1000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, weight = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        weight += 1 + len(str(row[-2])) // 4096
        if weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
            held, weight = [], 0
    columns = zip(*held, strict=True) if held else [()] * len(arrow)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def reports(turns: DataFrame, stays: Column | None = None) -> DataFrame:
    """A row for each ``conv_id``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Turns are taken by ``turn``, nulls first, ties by role and text. Null roles and texts count as one space, so such a text is
    blank; a null ``conv_id`` is a conversation too. Of a turn's faults the first counts. ``stays`` leaves
    turns out without losing their conversation: one without turns has zeros, an empty audit and the hash of no
    text. Other columns go. Texts and conversations of any length are read whole. No rows give none.
    """
    schema = T.StructType().add(turns.schema["conv_id"])
    for name in ("gaps", *FAULTS, "illegal", "cost"):
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for it in _streamed(batches):
            cost, audit = align(it.turns)
            digest, between = hashlib.sha256(), b""
            for _, role, text in it.repaired(audit):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield it.conv_id, it.gaps, *it.counts[:3], it.illegal, cost, audit, digest.hexdigest()

    return prepared(turns, stays).mapInArrow(lambda batches: _batches(rows(batches), schema), schema)


def repair(turns: DataFrame, stays: Column | None = None) -> DataFrame:
    """The repaired turns: ``conv_id``, ``place`` from 0, ``edit`` (K kept, R re-roled, I inserted), ``text``, ``role``.

    Rows are taken as in :func:`reports`.
    """
    schema = T.StructType().add(turns.schema["conv_id"]).add("place", "long").add("edit", "string").add("text", "string").add("role", "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for it in _streamed(batches):
            for place, (edit, role, text) in enumerate(it.repaired(align(it.turns)[1])):
                yield it.conv_id, place, edit, text, role

    return prepared(turns, stays).mapInArrow(lambda batches: _batches(rows(batches), schema), schema)
