"""Repair of the structure of conversations by lightest derivations.

The turns of a repaired conversation read ``(s?(ua)+)?`` by the first letters of their roles: an
optional system turn, then user and assistant in turn. Each row is kept, given another role or
deleted, and empty turns may be inserted; ``lightest`` finds the cheapest edits, ties to the
least audit (the letters of the edits, in order). Blank rows and rows that repeat an earlier one
must go.

Rows are sorted within hash partitions of their conversation and streamed, one conversation in
memory at a time. A conversation of more than ``SEGMENT_ROWS`` rows is cut along its order into
segments, whatever its size. A segment gives the lightest edits from each state to each (insertions
after its last row belong to the next one, so two audits from one state are never one the
beginning of the other), and the chain of segments is again a lightest derivation, over their
costs and the ranks of their audits. Its states go back to the segments, which apply their edits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from recurra.llm.lightest import Edit, lightest
from recurra.operators.hotkeys import find_hot_keys
from recurra.session import stage

#: Rows from which a conversation is cut into segments of about so many.
SEGMENT_ROWS = 20_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
COMPLETE = (NOTHING, ASSISTANT)
#: States from which a turn with this initial may come, and the one it leads to.
FOLLOWS = {"s": ((NOTHING,), SYSTEM), "u": ((NOTHING, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
INSERTS: list[Edit] = [
    (q, to, INSERT, "I") for i in "ua" for before, to in [FOLLOWS[i]] for q in before
]

_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_SPACES = " \t\n\x0b\x0c\r"

#: What a row is found to be; a row's first fault counts.
SOUND, BLANK, REPEATED, TRUNCATED = range(4)

ROWS = "role string, text string, copies long, first boolean"
SUMMARY = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


# --- the rows -----------------------------------------------------------------------------


def _given(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated or given to the user.

    Which row suffers what follows from CRC-32 of ``key:turn`` modulo 20 (a null reads as one
    space): 0 drops it, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 sets its role to
    user. Dropped rows stay with ``copies`` 0, so that their conversation is not forgotten.
    """
    kind = F.crc32(F.concat(_given(F.col(key)), F.lit(":"), _given(F.col(turn)))) % 20
    said = _given(F.col(text))
    return conversations.select(
        F.col(key),
        F.col(turn),
        F.when(kind == 4, F.lit("user")).otherwise(_given(F.col(role))).alias(role),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(said, "[.!?]", ""))
        .otherwise(said)
        .alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _prepared(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    copies = F.col("copies").cast("long") if "copies" in df.columns else F.lit(1).cast("long")
    return df.select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"),
        _given(F.col(role)).alias("role"), _given(F.col(text)).alias("text"),
        copies.alias("copies"), F.lit(None).cast("boolean").alias("first"),
    )


def _first_of_kind(rows: DataFrame) -> DataFrame:
    """Rows of long conversations, alike ones as one with their number of ``copies``, marked with
    whether no earlier row has their role and text."""
    alike = stage(
        rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns"
    )
    said = F.sha2(F.concat(F.col("role"), F.lit("\x00"), F.col("text")), 256)
    # Null turns come first.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = alike.where("copies > 0").groupBy("conv", said.alias("said")).agg(
        F.min(place).alias("place")
    ).select(
        F.struct("conv", "place").alias("at"), F.col("said").alias("known_said"),
        F.lit(True).alias("found"),
    )
    # A pair of a place and what is said is in one row only, so no task is hot.
    match = (F.struct(alike["conv"], place.alias("place")).eqNullSafe(firsts["at"])) & (
        said == firsts["known_said"]
    )
    return alike.join(firsts, match, "left").select(
        "conv", "turn", "role", "text", "copies", F.coalesce("found", F.lit(False)).alias("first")
    )


# --- one conversation, or one segment of it -------------------------------------------------


class Turns:
    """The rows of a conversation or segment in order, with what is wrong with them."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, int]] = []  # role, text, fault
        self.copies: list[int] = []
        self.turns = 0
        self.low = self.high = None
        self._seen: set[tuple[str, str]] = set()

    def add(self, turn: int | None, role: str, text: str, copies: int, first: bool | None) -> None:
        if not copies:
            return
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if first is None:
            first = (role, text) not in self._seen
            self._seen.add((role, text))
        if not _BLANK.search(text):
            self._put(role, text, BLANK, copies)
            return
        if first:
            ends = text.rstrip(_SPACES)[-1]
            self._put(role, text, SOUND if ends in ".!?" else TRUNCATED, 1)
        if copies > first:
            self._put(role, text, REPEATED, copies - first)

    def _put(self, role: str, text: str, fault: int, copies: int) -> None:
        self.rows.append((role, text, fault))
        self.copies.append(copies)

    def edits(self) -> list[list[Edit]]:
        """The edits of each row; alike rows that must go are deleted together, which is never
        dearer and has the least audit."""
        out = []
        for (role, _, fault), copies in zip(self.rows, self.copies):
            gone = [(q, q, DELETE * copies, "D" * copies) for q in STATES]
            if fault not in (BLANK, REPEATED):
                extra = CUT if fault == TRUNCATED else 0
                before, to = FOLLOWS.get(role[:1], ((), 0))
                gone += [(q, to, KEEP + extra, "K") for q in before]
                for initial in "ua":
                    before, to = FOLLOWS[initial]
                    gone += [(q, to, REROLE + extra, "R") for q in before]
            out.append(gone)
        return out

    def count(self, fault: int) -> int:
        return sum(c for (_, _, f), c in zip(self.rows, self.copies) if f == fault)

    def illegal(self) -> int:
        """Neighbours whose initials may not follow each other, copies included."""
        initials = [role[:1] for role, _, _ in self.rows]
        inside = sum(c - 1 for c in self.copies)  # no initial may follow itself
        return inside + sum(pair not in LEGAL for pair in zip(initials, initials[1:]))

    def repaired(self, audit: str, state: int) -> Iterator[tuple[str, str, str]]:
        """Letter, role and text of each turn that the edits leave, from a state on."""
        at = 0
        left = self.copies[0] if self.copies else 0
        for letter in audit:
            if letter == "I":
                state = ASSISTANT if state == USER else USER
                yield letter, ROLES[state], ""
                continue
            role, text, _ = self.rows[at]
            if letter == "K":
                state = FOLLOWS[role[:1]][1]
                yield letter, role, text
            elif letter == "R":
                state = ASSISTANT if state == USER else USER
                yield letter, ROLES[state], text
            left -= 1
            if not left:
                at += 1
                left = self.copies[at] if at < len(self.copies) else 0


def _units(
    batches: Iterator[pa.RecordBatch], unit: list[str]
) -> Iterator[tuple[tuple, Turns, tuple]]:
    """Key, turns and extra columns of each run of rows that agree in the columns ``unit``."""
    current, turns, extra = None, None, ()
    for batch in batches:
        columns = {f.name: batch.column(f.name).to_pylist() for f in batch.schema}
        own = [columns[c] for c in unit]
        more = [v for c, v in columns.items() if c.startswith("given_")]
        named = zip(*[columns[c] for c in ("turn", "role", "text", "copies", "first")])
        for i, row in enumerate(named):
            key = tuple(c[i] for c in own)
            if key != current:
                if turns is not None:
                    yield current, turns, extra
                current, turns, extra = key, Turns(), tuple(c[i] for c in more)
            turns.add(*row)
    if turns is not None:
        yield current, turns, extra


def _stream(
    rows: DataFrame, unit: list[str], schema: str,
    per_unit: Callable[[tuple, Turns, tuple], list[tuple]], rows_a_batch: int = 2000,
) -> DataFrame:
    """``per_unit`` over each unit's turns in order; units are streamed within a task."""
    target = to_arrow_schema(StructType.fromDDL(schema))
    placed = rows.repartition(*unit).sortWithinPartitions(*unit, "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch_of(rows):
            columns = zip(*rows) if rows else [()] * len(target)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, target)], schema=target
            )

        for key, turns, extra in _units(batches, unit):
            held += per_unit(key, turns, extra)
            if len(held) >= rows_a_batch:
                yield batch_of(held)
                held = []
        yield batch_of(held)

    return placed.mapInArrow(run, schema)


# --- whole conversations --------------------------------------------------------------------


def _lightest_whole(turns: Turns) -> tuple[int, str]:
    (cost, audit), = lightest(turns.edits(), INSERTS, NOTHING, COMPLETE).values()
    return cost, audit


def _line(role: str, text: str) -> str:
    return f"{role}:{text}"


def _digest(lines: Iterator[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _summary(key: tuple, turns: Turns, extra: tuple) -> list[tuple]:
    cost, audit = _lightest_whole(turns)
    gaps = 0 if turns.low is None else turns.high - turns.low + 1 - turns.turns
    faults = [turns.count(f) for f in (BLANK, REPEATED, TRUNCATED)]
    lines = (_line(role, text) for _, role, text in turns.repaired(audit, NOTHING))
    return [(*key, gaps, *faults, turns.illegal(), cost, audit, _digest(lines))]


def _turns_left(key: tuple, turns: Turns, extra: tuple) -> list[tuple]:
    _, audit = _lightest_whole(turns)
    return [
        (*key, 0, i, letter, role, text)
        for i, (letter, role, text) in enumerate(turns.repaired(audit, NOTHING))
    ]


# --- long conversations, by segments --------------------------------------------------------

SEGMENT = (
    "turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, "
    "head string, tail string, costs array<long>, ranks array<int>, ends array<long>, "
    "goals array<int>"
)


def _segment(key: tuple, turns: Turns, extra: tuple) -> list[tuple]:
    """What the chain needs of a segment: sizes, faults, edge initials, and for each state before
    it the cost and rank of the lightest edits to each state after it (-1: none), and the cost and
    last state of the lightest ones that complete a conversation here."""
    steps = turns.edits()
    costs, ranks, ends, goals = [], [], [], []
    for start in STATES:
        found = lightest(steps, INSERTS, start, insert_last=False)
        order = sorted(found, key=lambda q: found[q][1])
        costs += [found[q][0] if q in found else -1 for q in STATES]
        ranks += [order.index(q) if q in found else -1 for q in STATES]
        (state, (cost, _)), = lightest(steps, INSERTS, start, COMPLETE).items()
        ends.append(cost)
        goals.append(state)
    rows = turns.rows
    return [(
        *key, turns.turns, turns.low, turns.high, turns.count(BLANK), turns.count(REPEATED),
        turns.count(TRUNCATED), turns.illegal(), rows[0][0][:1] if rows else None,
        rows[-1][0][:1] if rows else None, costs, ranks, ends, goals,
    )]


CHOICE = (
    "conv {kind}, segment int, given_start int, given_end int, given_last boolean, gaps long, "
    "blank long, duplicate long, truncated long, illegal long, cost long"
)


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """The states before and after each segment of one conversation; totals on each row.

    A frame has one short row a segment.
    """
    frame = frame.sort_values("segment", kind="stable").reset_index(drop=True)
    steps = []
    last = len(frame) - 1
    for i, row in enumerate(frame.itertuples()):
        if i == last:
            steps.append([(q, 0, int(row.ends[q]), "0") for q in STATES])
        else:
            steps.append([
                (q, to, int(row.costs[4 * q + to]), str(row.ranks[4 * q + to]))
                for q in STATES for to in STATES if row.costs[4 * q + to] >= 0
            ])
    (cost, path), = lightest(steps, (), NOTHING, (0,)).values()
    states = [NOTHING]
    for step, rank in zip(steps[:-1], path):
        states.append(next(to for q, to, _, r in step if q == states[-1] and r == rank))
    known = frame[frame["low"].notna()]
    distinct = known["turns"].sum() - (known["high"].shift() == known["low"]).sum()
    gaps = 0 if known.empty else known["high"].iloc[-1] - known["low"].iloc[0] + 1 - distinct
    seen = frame[frame["head"].notna()]
    edges = zip(seen["tail"], seen["head"].shift(-1).iloc[:-1])
    out = pd.DataFrame({
        "conv": frame["conv"], "segment": frame["segment"], "given_start": states,
        "given_end": [*states[1:], NOTHING], "given_last": frame.index == last,
    })
    totals = frame[["blank", "duplicate", "truncated"]].sum()
    illegal = frame["illegal"].sum() + sum(e not in LEGAL for e in edges)
    return out.assign(
        gaps=int(gaps), **totals.astype(int), illegal=int(illegal), cost=int(cost)
    )


def _part_of_audit(turns: Turns, start: int, end: int, last: bool) -> str:
    if last:
        (_, audit), = lightest(turns.edits(), INSERTS, start, COMPLETE).values()
        return audit
    return lightest(turns.edits(), INSERTS, start, insert_last=False)[end][1]


def _segment_lines(key: tuple, turns: Turns, extra: tuple) -> list[tuple]:
    audit = _part_of_audit(turns, *extra)
    lines = "\n".join(_line(r, t) for _, r, t in turns.repaired(audit, extra[0]))
    left = any(letter != "D" for letter in audit)
    return [(*key, audit, lines if left else None)]


def _segment_left(key: tuple, turns: Turns, extra: tuple) -> list[tuple]:
    audit = _part_of_audit(turns, *extra)
    return [
        (*key, i, letter, role, text)
        for i, (letter, role, text) in enumerate(turns.repaired(audit, extra[0]))
    ]


def _assemble(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The audit and digest of each conversation from its segments, read in order; a segment's
    lines are let go once they are in the digest."""
    current, audits, digest, begun = None, [], None, False

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], type=f.type) for x, f in
             zip((current[0], "".join(audits), digest.hexdigest()), schema)], schema=schema
        )

    for batch in batches:
        for i in range(batch.num_rows):
            conv, _, audit, lines = (batch.column(c)[i].as_py() for c in range(4))
            if current != (conv,):
                if current is not None:
                    yield row()
                current, audits, digest, begun = (conv,), [], hashlib.sha256(), False
            audits.append(audit)
            if lines is not None:
                digest.update((("\n" if begun else "") + lines).encode())
                begun = True
    if current is not None:
        yield row()


class _Long:
    """Conversations over the row limit: their segments and the states between them."""

    def __init__(self, rows: DataFrame, slices: int, kind: str):
        self.kind = kind
        cut = (
            _first_of_kind(rows)
            .repartitionByRange(slices, "conv", "turn", "role", "text")
            .withColumn("segment", F.spark_partition_id())
        )
        self.rows = stage(cut, "segments")
        unit = f"conv {kind}, segment int, "
        segments = _stream(self.rows, ["conv", "segment"], unit + SEGMENT, _segment)
        self.choices = stage(
            segments.groupBy("conv").applyInPandas(_chain, CHOICE.format(kind=kind)), "choices"
        )

    def given(self) -> DataFrame:
        """Rows with the states around their segment; a choice per segment is broadcast, no more
        than range partitions and long conversations."""
        choice = self.choices.select(
            F.struct("conv", "segment").alias("unit"), "given_start", "given_end", "given_last"
        )
        match = F.struct(self.rows["conv"], self.rows["segment"]).eqNullSafe(choice["unit"])
        return self.rows.join(F.broadcast(choice), match).drop("unit")

    def turns_left(self, schema: str) -> DataFrame:
        return _stream(self.given(), ["conv", "segment"], schema, _segment_left)

    def summaries(self) -> DataFrame:
        kind = self.kind
        parts = _stream(
            self.given(), ["conv", "segment"],
            f"conv {kind}, segment int, audit string, lines string", _segment_lines, 1,
        )
        placed = parts.repartition("conv").sortWithinPartitions("conv", "segment")
        schema = f"conv {kind}, audit string, repaired_sha256 string"
        target = to_arrow_schema(StructType.fromDDL(schema))
        whole = placed.mapInArrow(partial(_assemble, schema=target), schema)
        totals = self.choices.where("given_last").select(
            F.col("conv").alias("of"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
        )
        return totals.join(whole, whole["conv"].eqNullSafe(totals["of"])).select(
            "conv", *[f.name for f in StructType.fromDDL(SUMMARY)]
        )


def _split(
    df: DataFrame, key: str, turn: str, role: str, text: str, segment_rows: int
) -> tuple[DataFrame, _Long | None, str]:
    kind = df.schema[key].dataType.simpleString()
    rows = _prepared(df, key, turn, role, text)
    hot = find_hot_keys(rows.select("conv"), ["conv"], segment_rows)
    if not hot:
        return rows, None, kind
    return hot.cold(rows), _Long(hot.hot(rows), hot.slices, kind), kind


def repair_summaries(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Per conversation: key, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows are taken by turn (null first), then role and text; a null role or text reads as one
    space, a null key is a conversation of its own. A column ``copies``, if there, tells how often
    a row stands there; a conversation with nothing but rows of 0 copies has zeros, an empty audit
    and the digest of nothing. An empty role has no initial, so its row is given a role or
    deleted. Other columns are left out, so none can clash; an empty table gives no row.
    """
    rows, long, kind = _split(conversations, key, turn, role, text, segment_rows)
    out = _stream(rows, ["conv"], f"conv {kind}, {SUMMARY}", _summary)
    if long:
        out = out.unionByName(long.summaries())
    return out.withColumnRenamed("conv", key)


def repair(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """The turns of repaired conversations: key, segment, turn, edit, role, text.

    ``turn`` counts from 0 within a segment (0 but for long conversations), ``edit`` is K, R or I.
    Conversations of which nothing is left give no row; else as in ``repair_summaries``.
    """
    rows, long, kind = _split(conversations, key, turn, role, text, segment_rows)
    schema = f"conv {kind}, segment int, turn long, edit string, role string, text string"
    out = _stream(rows, ["conv"], schema, _turns_left)
    if long:
        out = out.unionByName(long.turns_left(schema))
    return out.withColumnRenamed("conv", key)
