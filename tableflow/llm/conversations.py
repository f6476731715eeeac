"""Conversation structure repair: the cheapest edits that make turns alternate, by lightest derivation.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Repair is a weighted deduction: an item
says that the rows up to some place are repaired and which part of the pattern has been written; axioms are the
states a span may begin in; a rule leads from an item over an edit of the next row (Keep, Rerole, Delete) or
over an Insert, or over a whole span whose lightest derivations are known, to the next item. An item's value is (cost, audit), the audit being the
edits' initials. Every rule adds a cost of 0 or more and appends to the audit, so no value is less than
that it came from, and of two values of one item the lesser one stays so under every rule (two audits
of the same cost over the same rows are never one the other's beginning: it would take an Insert more). These are the
conditions of Knuth's algorithm: items are popped from an agenda by least value, the first time they are popped
their value is final, and the search ends when the goal is popped.

Scale: equal rows are counted map-side before any shuffle. Rows are then sorted by conversation and
turn over range partitions, so that a conversation that holds a third of all rows lies in many tasks, as
neighbouring chunks. Of a conversation cut by a partition border, each chunk first gives the lightest
derivation between all states; a fold over these few rows finds the state at each border; then
chunks are repaired on their own like whole conversations. A task holds the rows of one chunk, within
one partition. Spans longer than ``BLOCK`` rows are derived from the spans of their blocks.

Defined cases: a null role or text is one space, a null id or turn is one space where it is hashed; null turns
come first; rows of the same turn are ordered by role and text (bytes), equal ones are neighbours. A null id is a
conversation of its own, which goes by the id of -2^63 and is reported as null. An Insert that could stand on either side of a Delete comes after it. Rows
of conversations that lose all rows are reported as empty ones. A very long text is hashed once and held by one task.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.shared import NO_ID, order_id, stored

#: rows whose derivations are found edit by edit
BLOCK = 256
#: characters of a text by which range partitions may part rows of one turn
PREFIX = 64

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: what has been written: nothing, a system turn, a user turn, an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
COMPLETE = (START, ASSISTANT)
#: state after a turn that begins with an initial
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: the role that may be given or inserted, and the state after it
GIVEN = {
    START: ("user", USER),
    SYSTEM: ("user", USER),
    USER: ("assistant", ASSISTANT),
    ASSISTANT: ("user", USER),
}
LEGAL = ("su", "ua", "au")
#: faults, the first of which counts
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
_WHITE = " \t\n\x0b\x0c\r"

Value = tuple[int, str]
#: (initial, fault, times) of a row; all but the first of several equal ones are duplicates
Row = tuple[str, str, int]


def lightest(
    axioms: Iterable[tuple[int, str, tuple[int, int]]],
    rules: Callable[[tuple[int, int]], Iterator[tuple[int, str, tuple[int, int]]]],
    is_goal: Callable[[tuple[int, int]], bool] | None = None,
) -> tuple[dict[tuple[int, int], Value], tuple[int, int] | None]:
    """(final values of the items popped, the goal popped if one is asked for)."""
    agenda = list(axioms)
    heapq.heapify(agenda)
    final: dict[tuple[int, int], Value] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if is_goal and is_goal(item):
            return final, item
        for weight, letters, then in rules(item):
            if then not in final:
                heapq.heappush(agenda, (cost + weight, audit + letters, then))
    return final, None


def edits_of(rows: list[Row]):
    """Rules over the edits of each row. Item: (rows behind it, state)."""

    def rules(item: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
        at, state = item
        _, given = GIVEN[state]
        yield INSERT, "I", (at, given)
        if at == len(rows):
            return
        initial, fault, times = rows[at]
        if fault in (BLANK, DUPLICATE):
            yield DELETE * times, "D" * times, (at + 1, state)
            return
        # copies of a row that stays are duplicates, which have to go; a Delete stands before an Insert
        copies, gone = DELETE * (times - 1), "D" * (times - 1)
        stays = copies + (TRUNCATED if fault == CUT else 0)
        yield DELETE + copies, "D" + gone, (at + 1, state)
        yield REROLE + stays, "R" + gone, (at + 1, given)
        if (state, initial) in AFTER:
            yield KEEP + stays, "K" + gone, (at + 1, AFTER[state, initial])

    return rules


def spans_in(spans: list[dict[tuple[int, int], Value]]):
    """Rules over whole spans. Item: (spans behind it, state)."""

    def rules(item: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
        at, state = item
        if at < len(spans):
            for (entry, end), (cost, audit) in spans[at].items():
                if entry == state:
                    yield cost, audit, (at + 1, end)

    return rules


def _parts(rows: list[Row]):
    """(rules over a list of rows, number of the last place)."""
    if len(rows) <= BLOCK:
        return edits_of(rows), len(rows)
    spans = [span_of(rows[low : low + BLOCK]) for low in range(0, len(rows), BLOCK)]
    return spans_in(spans), len(spans)


def span_of(rows: list[Row]) -> dict[tuple[int, int], Value]:
    """The lightest derivation from each state before the rows to each after them."""
    rules, last = _parts(rows)
    found = {}
    for entry in STATES:
        for (at, end), value in lightest([(0, "", (0, entry))], rules)[0].items():
            if at == last:
                found[entry, end] = value
    return found


def audit_of(rows: list[Row], entry: int = START, ends: tuple[int, ...] = COMPLETE) -> Value:
    """(cost, audit) of the lightest derivation from a state to one of the ends."""
    rules, last = _parts(rows)
    final, goal = lightest([(0, "", (0, entry))], rules, lambda item: item[0] == last and item[1] in ends)
    return final[goal]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, times: what is left of the rows, equal ones counted.

    A row without role and text (``times`` 0) stands for the dropped ones of a conversation.
    """
    named = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" ")))
    stays = kind != 0
    rows = conversations.select(
        order_id("conv_id").alias("conv"),
        F.when(stays, F.col("turn").cast("long")).alias("turn"),
        F.when(stays, role).alias("role"),
        F.when(stays, text).alias("text"),
        F.when(kind == 3, 2).when(stays, 1).otherwise(0).alias("times"),
    )
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))


def with_faults(rows: DataFrame) -> DataFrame:
    """``fault`` of the first of each row's copies; null if it has none."""
    bare = F.rtrim("text", F.lit(_WHITE))
    rows = rows.withColumn("key", F.when(bare != "", F.xxhash64("role", "text")))
    # the first turn of a role and text that several turns have; null turns come first
    several = rows.where("key is not null").groupBy("conv", "key").agg(
        F.count("*").alias("turns"), F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("unnumbered")
    )
    several = several.where("turns > 1").drop("turns")
    later = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    fault = (
        F.when(bare == "", BLANK).when(later, DUPLICATE).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT)
    )
    found = rows.join(several, ["conv", "key"], "left").withColumn("fault", fault)
    return found.select("conv", "turn", "role", "text", "times", "fault")


def in_order(rows: DataFrame) -> DataFrame:
    """The rows by conversation and turn over stored partitions, with the number of their ``chunk``."""
    short = [F.substring(name, 1, PREFIX) for name in ("role", "text")]
    ranged = rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), *short)
    sorted_ = ranged.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return stored(sorted_.withColumn("chunk", F.spark_partition_id()))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(conversation, its rows) in the order they come."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for conv, own in groupby(rows, key=lambda row: row[0]):
        yield conv, list(own)


def _plain(rows: list[tuple]) -> list[Row]:
    """What derivations need of (conv, turn, role, text, times, fault, chunk) rows that are not dropped."""
    return [(role[:1], fault or "", times) for _, _, role, _, times, fault, _ in rows if times]


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, rows in _groups(batches):
        found = [(conv, rows[0][-1], *states, *value) for states, value in span_of(_plain(rows)).items()]
        columns = [pa.array(values) for values in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "chunk", "entry", "end", "cost", "audit"])


def _border_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, chunk, entry, end): the states on the lightest way through all chunks; sorted by both."""

    def way(conv: int, chunks: list[int], came: list[dict[int, int]], ends: dict[int, Value]):
        state = min((value, state) for state, value in ends.items() if state in COMPLETE)[1]
        rows = []
        for chunk, before in zip(reversed(chunks), reversed(came), strict=True):
            rows.append((conv, chunk, before[state], state))
            state = before[state]
        columns = [pa.array(values, pa.int64()) for values in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["conv", "chunk", "entry", "end"])

    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for conv, own in groupby(rows, key=lambda row: row[0]):
        chunks, came, reached = [], [], {START: (0, "")}
        for chunk, spans in groupby(own, key=lambda row: row[1]):
            span = {(entry, end): (cost, audit) for _, _, entry, end, cost, audit in spans}
            best: dict[int, tuple[Value, int]] = {}
            for entry, value in reached.items():
                final, _ = lightest([(*value, (0, entry))], spans_in([span]))
                for (at, end), own_value in final.items():
                    if at and (end not in best or own_value < best[end][0]):
                        best[end] = (own_value, entry)
            chunks.append(chunk)
            came.append({end: entry for end, (_, entry) in best.items()})
            reached = {end: value for end, (value, _) in best.items()}
        yield way(conv, chunks, came, reached)


def _turn_rows(borders: dict[tuple[int, int], tuple[int, int]]):
    def repaired(conv: int, rows: list[tuple]) -> Iterator[tuple]:
        chunk = rows[0][-1]
        entry, end = borders.get((conv, chunk), (START, None))
        _, audit = audit_of(_plain(rows), entry, COMPLETE if end is None else (end,))
        state, at, place = entry, 0, 0

        def inserted() -> Iterator[tuple]:
            nonlocal state, at, place
            while audit[at : at + 1] == "I":
                role, state = GIVEN[state]
                yield conv, chunk, place, "I", 1, None, None, None, role, ""
                at, place = at + 1, place + 1

        yield from inserted()
        for _, turn, role, text, times, fault, _ in rows:
            if not times:
                yield conv, chunk, place, None, 0, None, None, None, None, None
                place += 1
                continue
            edit, deletes = audit[at], times - 1
            now = role
            if fault in (BLANK, DUPLICATE):
                edit, deletes = "D", times
            elif edit == "D":
                yield conv, chunk, place, "D", 1, turn, role, fault, None, None
                place += 1
            else:
                if edit == "R":
                    now, state = GIVEN[state]
                else:
                    state = AFTER[state, role[:1]]
                yield conv, chunk, place, edit, 1, turn, role, fault, now, text
                place += 1
            if deletes:
                why = fault if fault in (BLANK, DUPLICATE) else DUPLICATE
                yield conv, chunk, place, "D", deletes, turn, role, why, None, None
                place += 1
            at += times
            yield from inserted()

    names = ["conv", "chunk", "place", "edit", "times", "turn", "old_role", "fault", "role", "text"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for conv, own in _groups(batches):
            for row in repaired(conv, own):
                waiting.append(row)
                size += 100 + len(row[-1] or "")
                if size > 1 << 20:
                    yield batch_of(waiting)
                    waiting, size = [], 0
        if waiting:
            yield batch_of(waiting)

    return rows


_TURNS = (
    "conv long, chunk int, place long, edit string, times long, turn long, old_role string, fault string, "
    "role string, text string"
)


class Repaired:
    """The repaired conversations, as ``turns``; those cut by a partition border lie apart."""

    def __init__(self, conversations: DataFrame):
        rows = in_order(with_faults(damaged(conversations)))
        # at most one for each partition border
        ends = rows.groupBy("conv").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
        cut = [row["conv"] for row in ends.where("low < high").select("conv").collect()]
        self.is_cut = F.col("conv").isin(cut) if cut else F.lit(False)
        borders = {}
        if cut:
            spans = rows.where(self.is_cut).mapInArrow(
                _span_rows, "conv long, chunk long, entry long, end long, cost long, audit string"
            )
            by_chunk = stored(spans).repartition("conv").sortWithinPartitions("conv", "chunk")
            found = by_chunk.mapInArrow(_border_rows, "conv long, chunk long, entry long, end long").collect()
            borders = {(row["conv"], row["chunk"]): (row["entry"], row["end"]) for row in found}
        self.rows, self.repair = rows, _turn_rows(borders)

    def whole(self) -> DataFrame:
        """Turns of conversations that lie in one partition, in order."""
        return self.rows.where(~self.is_cut).mapInArrow(self.repair, _TURNS)

    def pieces(self) -> DataFrame:
        """Turns of the others, in order within each chunk."""
        return self.rows.where(self.is_cut).mapInArrow(self.repair, _TURNS)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, chunk, place, edit, times, turn, old_role, fault, role, text: every edit, in order of (chunk, place).

    Kept, reroled and inserted turns have their new ``role`` and ``text``, deleted ones none; ``times`` counts
    equal deleted ones. Turns without an edit stand for conversations' dropped rows.
    """
    found = Repaired(conversations)
    turns = found.whole().unionByName(found.pieces())
    return turns.select(_reported("conv").alias("conv_id"), *[name for name in turns.columns if name != "conv"])


def _reported(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its turns in order; holds no text but the present one."""
    weights = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out: list[tuple] = []
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for conv, turns in groupby(rows, key=lambda row: row[0]):
        digest, audit, faults = hashlib.sha256(), [], {BLANK: 0, DUPLICATE: 0, CUT: 0}
        low = high = last = None
        cost = illegal = distinct = 0
        before, first = None, True
        for _, _, _, edit, times, turn, old_role, fault, role, text in turns:
            if edit is None:
                continue
            audit.append(edit * times)
            cost += weights[edit] * times + (fault == CUT and edit != "D")
            if edit != "I":
                if fault:
                    faults[fault] += times
                if turn is not None and turn != last:
                    low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
                initial = old_role[:1]
                illegal += before is not None and before + initial not in LEGAL
                illegal += times - 1
                before = initial
            if edit != "D":
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        gaps = 0 if low is None else high - low + 1 - distinct
        counts = [faults[name] for name in (BLANK, DUPLICATE, CUT)]
        out.append((conv, gaps, *counts, illegal, cost, "".join(audit), digest.hexdigest()))
        if len(out) == 1000:
            yield pa.RecordBatch.from_arrays([pa.array(values) for values in zip(*out, strict=True)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(values) for values in zip(*out, strict=True)], names)


def op13_conversations(spark, sf_dir):
    found = Repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    schema = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    schema += ", audit string, repaired_sha256 string"
    # a hash needs a conversation's text in order: it streams through one task
    pieces = found.pieces().repartition("conv").sortWithinPartitions("conv", "chunk", "place")
    digests = found.whole().mapInArrow(_digest_rows, schema).unionByName(pieces.mapInArrow(_digest_rows, schema))
    return digests.select(_reported("conv").alias("conv_id"), *[name for name in digests.columns if name != "conv"])
