"""Repair of conversation structure by lightest derivation.

A conversation is right if the first letters of its roles read ``(s?(ua)+)?``. Rows may be
kept, given another role, deleted, or inserted; the cheapest edits win, and among equally
cheap ones those whose letters (the audit) come first in ASCII order.

The repair is a weighted deduction. An item (rows consumed from the end, automaton state)
says that these rows can be edited into what the automaton still accepts from the state;
its weight is (cost, rows, audit). An edit puts its letter in front of the audit and never
makes the weight smaller, so the functions are superior, and Knuth's agenda pops every
item with its lightest derivation first. It stops when the goal is popped.

A conversation of any length is cut into segments. A segment does not know its neighbours,
so its lightest derivation is found for each pair of states at its ends. A second agenda
joins these spans: an item (segments left, state) follows from a span and the item behind
it, a deduction with two antecedents. Audits of one span with one cost are never each
other's beginnings (that would take an insertion more), so joining keeps their order.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass
from itertools import zip_longest

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import sliced
from clickloom.sources.shared import stage

# Rows and text bytes of a segment at most (a longer row is a segment alone).
SEGMENT_ROWS = 512
SEGMENT_BYTES = 1 << 20

# Beginning of a text by which rows of one turn and role are dealt out.
DEALT_CHARACTERS = 256

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# Automaton of (s?(ua)+)?: state and letter give the next state.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
STEPS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ACCEPTING = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# What is wrong with a row.
FINE, CUT_OFF, BAD = range(3)


def lightest(
    axioms: Iterable[tuple[tuple, Hashable]],
    consequences: Callable[[Hashable, tuple, dict], Iterable[tuple[tuple, Hashable]]],
    goals: set,
) -> dict:
    """Lightest weight of each item popped until all goals are.

    ``consequences`` gives weights and items of the deductions that an item completes,
    from the item, its weight and what was popped before. Weights have to be superior:
    not below the weight of any antecedent, and smaller for smaller ones.
    """
    agenda = list(axioms)
    heapq.heapify(agenda)
    found: dict = {}
    missing = set(goals)
    while agenda and missing:
        weight, item = heapq.heappop(agenda)
        if item in found:
            continue
        found[item] = weight
        missing.discard(item)
        for new in consequences(item, weight, found):
            if new[1] not in found:
                heapq.heappush(agenda, new)
    return found


def _row_deductions(rows: list[tuple[str, int]], item, weight, _found) -> Iterator:
    """Edits of the row before an item, and insertions there. rows: (initial, fault)."""
    done, after = item
    cost, _, audit = weight
    for state, steps in STEPS.items():
        for letter in ROLES:
            if steps.get(letter) == after:
                yield (cost + INSERT, done, "I" + audit), (done, state)
    if done == len(rows):
        return
    initial, fault = rows[-1 - done]
    yield (cost + DELETE, done + 1, "D" + audit), (done + 1, after)
    if fault == BAD:
        return
    extra = cost + (TRUNCATED if fault == CUT_OFF else 0)
    for state, steps in STEPS.items():
        if steps.get(initial) == after:
            yield (extra, done + 1, "K" + audit), (done + 1, state)
        if any(steps.get(letter) == after for letter in ROLES):
            yield (extra + REROLE, done + 1, "R" + audit), (done + 1, state)


def repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation of (role initial, fault) rows."""
    goal = len(rows), START
    axioms = [((0, 0, ""), (0, state)) for state in ACCEPTING]
    cost, _, audit = lightest(axioms, functools.partial(_row_deductions, rows), {goal})[goal]
    return cost, audit


def spans(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """(entry state, exit state, cost, audit) of a segment, for all states that fit."""
    made = []
    goals = {(len(rows), state) for state in STATES}
    for leave in STATES:
        found = lightest([((0, 0, ""), (0, leave))], functools.partial(_row_deductions, rows), goals)
        for enter in STATES:
            if (len(rows), enter) in found:
                cost, _, audit = found[len(rows), enter]
                made.append((enter, leave, cost, audit))
    return made


class Rope:
    """Text in linked parts, compared as text; longer beginnings are not copied."""

    __slots__ = ("head", "rest")

    def __init__(self, head: str, rest: Rope | None = None):
        self.head, self.rest = head, rest

    def parts(self) -> Iterator[str]:
        rope = self
        while rope:
            yield rope.head
            rope = rope.rest

    def _letters(self) -> Iterator[str]:
        for part in self.parts():
            yield from part

    def __eq__(self, other) -> bool:
        return self is other or all(a == b for a, b in zip_longest(self._letters(), other._letters()))

    def __lt__(self, other) -> bool:
        if self is other:
            return False
        for a, b in zip_longest(self._letters(), other._letters(), fillvalue=""):
            if a != b:
                return a < b
        return False


def _joining(by_exit: list[dict], item, weight, found) -> Iterator:
    """Deductions from a span and the item behind it, whichever was popped last."""
    if len(item) == 4:  # a span: place counted from the end, entry, exit, number of rows
        place, enter, leave, _ = item
        behind = found.get((place, leave))
        pairs = [(weight, enter, behind)] if behind else []
        left = place + 1
    else:
        done, state = item
        left = done + 1
        pairs = [
            (found[span], span[1], weight)
            for span in (by_exit[done].get(state, ()) if done < len(by_exit) else ())
            if span in found
        ]
    for span, enter, behind in pairs:
        total = span[0] + behind[0], span[1] + behind[1], Rope(span[2].head, behind[2])
        yield total, (left, enter)


def join_spans(segments: list[list[tuple[int, int, int, str]]]) -> list[tuple[int, str]]:
    """(entry state, audit) of each segment of a conversation in its cheapest repair.

    Each segment is given by its spans, as ``spans`` makes them.
    """
    by_exit: list[dict] = []
    axioms: list = [((0, 0, Rope("")), (0, state)) for state in ACCEPTING]
    for place, known in enumerate(reversed(segments)):
        ends: dict = {}
        for enter, leave, cost, audit in known:
            rows = len(audit) - audit.count("I")
            span = (place, enter, leave, rows)
            ends.setdefault(leave, []).append(span)
            axioms.append(((cost, rows, Rope(audit)), span))
        by_exit.append(ends)
    goal = len(segments), START
    best = lightest(axioms, functools.partial(_joining, by_exit), {goal})[goal][2]
    chosen, state = [], START
    for known, audit in zip(segments, best.parts()):
        chosen.append((state, audit))
        state = next(leave for enter, leave, _, a in known if (enter, a) == (state, audit))
    return chosen


def edited(roles: list[str], texts: list[str], state: int, audit: str) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits of an audit, from an automaton state on."""
    made_roles, made_texts, row = [], [], iter(zip(roles, texts))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(row)
        if edit == "D":
            continue
        steps = STEPS[state]
        letter = role[:1] if edit == "K" else next(x for x in ROLES if x in steps)
        made_roles.append(role if edit == "K" else ROLES[letter])
        made_texts.append(text)
        state = steps[letter]
    return made_roles, made_texts


SEGMENTS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("number", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
        T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("enter", T.ArrayType(T.IntegerType())),
        T.StructField("leave", T.ArrayType(T.IntegerType())),
        T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ]
)


def _segment(rows: list[tuple[str, str, int]], whole: bool) -> dict:
    """Columns of a segment; of a whole conversation with its repaired rows."""
    initials = [role[:1] for role, _, _ in rows]
    roles, texts = [r[0] for r in rows], [r[1] for r in rows]
    plain = [(i, fault) for i, (_, _, fault) in zip(initials, rows)]
    made = {
        "whole": whole,
        "first": initials[0],
        "last": initials[-1],
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
    }
    if whole:
        cost, audit = repair(plain)
        roles, texts = edited(roles, texts, START, audit)
        return made | {"cost": cost, "audit": audit, "roles": roles, "texts": texts}
    enter, leave, costs, audits = map(list, zip(*spans(plain)))
    ends = {"enter": enter, "leave": leave, "costs": costs, "audits": audits}
    return made | {"roles": roles, "texts": texts} | ends


def _copies(row: dict) -> Iterator[tuple[str, str, int]]:
    """The copies of a row as (role, text, fault); all but a first one are duplicates."""
    fresh = row["is_first"] and row["fault"] != BAD
    if fresh:
        yield row["role"], row["text"], row["fault"]
    for _ in range(row["copies"] - fresh):
        yield row["role"], "", BAD


def _segment_batches(batches, schema: pa.Schema):
    """Segments of the sorted rows of a partition.

    The first and the last conversation of a partition may go on in the next one, so they
    count as cut; so does one with more rows than a segment takes.
    """
    part = TaskContext.get().partitionId()
    number = 0
    rows: list[tuple[str, str, int]] = []
    conversation = who = None
    size, cut = 0, True
    ready: list[dict] = []

    def close(whole: bool) -> None:
        nonlocal rows, size, number
        if rows:
            place = {"conv_id": conversation, "who": who, "part": part, "number": number}
            ready.append(place | _segment(rows, whole))
            number += 1
        rows, size = [], 0

    def made() -> pa.RecordBatch:
        filled = pa.RecordBatch.from_pylist(ready, schema=schema)
        ready.clear()
        return filled

    for batch in batches:
        for piece in sliced(batch, "text"):
            for row in piece.to_pylist():
                if row["who"] != who:
                    close(whole=not cut)
                    cut = who is None
                    conversation, who = row["conv_id"], row["who"]
                for copy in _copies(row):
                    if len(rows) >= SEGMENT_ROWS or size + len(copy[1]) > SEGMENT_BYTES:
                        close(whole=False)
                        cut = True
                    rows.append(copy)
                    size += len(copy[1])
            if ready:
                yield made()
    close(whole=False)
    if ready:
        yield made()


def _choose(segments):
    """Entry state and audit of all segments of one cut conversation."""
    segments = segments.sort_values(["part", "number"])
    known = [
        list(zip(*columns))
        for columns in zip(segments["enter"], segments["leave"], segments["costs"], segments["audits"])
    ]
    chosen = join_spans(known)
    cost = [
        next(c for e, _, c, a in spans_here if (e, a) == pick) for spans_here, pick in zip(known, chosen)
    ]
    made = segments[["who", "part", "number"]].copy()
    made["state"], made["audit"] = [c[0] for c in chosen], [c[1] for c in chosen]
    made["cost"] = cost
    return made


def _edit_batches(batches, schema: pa.Schema):
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            row["roles"], row["texts"] = edited(row["roles"], row["texts"], row.pop("state"), row["audit"])
            yield pa.RecordBatch.from_pylist([row], schema=schema)


def _hash_batches(batches, schema: pa.Schema):
    """One row for each cut conversation from its sorted segments, a segment at a time."""

    def finished():
        row = {
            "who": who,
            "illegal": illegal,
            "cost": cost,
            "audit": "".join(audits),
            "repaired_sha256": digest.hexdigest(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    who = None
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if row["who"] != who:
                if who is not None:
                    yield finished()
                who, last, illegal, cost, audits = row["who"], None, 0, 0, []
                digest, empty = hashlib.sha256(), True
            illegal += row["illegal"] + (last is not None and last + row["first"] not in LEGAL)
            cost += row["cost"]
            audits.append(row["audit"])
            last = row["last"]
            if row["lines"]:
                digest.update((row["lines"] if empty else "\n" + row["lines"]).encode())
                empty = False
    if who is not None:
        yield finished()


def _text_of(column: Column) -> Column:
    """A text that tells values apart and is never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _lines() -> Column:
    return F.array_join(
        F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n"
    )


def marked_turns(turns: DataFrame) -> DataFrame:
    """Different rows of each conversation with their copies, fault and whether first.

    Rows that are equal in all columns stand next to each other in any order, so they are
    counted. A row is the first of its role and text if no smaller turn has them.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = turns.select(
        "conv_id",
        _text_of(F.col("conv_id")).alias("who"),
        "turn",
        _text_of(F.col("turn")).alias("at"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    ).withColumn("digest", F.sha2("text", 256))
    fault = F.when(blank, BAD).when(ended, FINE).otherwise(CUT_OFF)
    distinct = rows.groupBy("who", "at", "role", "digest").agg(
        F.first("conv_id").alias("conv_id"),
        F.first("turn").alias("turn"),
        F.first("text").alias("text"),
        F.count("*").alias("copies"),
    )
    firsts = (
        rows.groupBy("who", "role", "digest")
        .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unset"))
        .select(
            "who",
            F.when(F.col("unset"), "-").otherwise(_text_of(F.col("least"))).alias("at"),
            "role",
            "digest",
            F.lit(True).alias("is_first"),
        )
    )
    return (
        distinct.join(firsts, ["who", "at", "role", "digest"], "left")
        .withColumn("is_first", F.coalesce("is_first", F.lit(False)))
        .withColumn("fault", fault)
    )


@dataclass(frozen=True)
class Repair:
    """Repaired conversations: ``reports`` has a row for each, ``turns`` their new rows.

    ``turns`` is ordered by (part, number, place) within a conversation.
    """

    reports: DataFrame
    turns: DataFrame


def _counts(marked: DataFrame) -> DataFrame:
    """Faults of each conversation, and turns missing between its first and last."""
    blank = F.when(F.col("fault") == BAD, F.col("copies")).otherwise(0)
    again = F.when(F.col("fault") == BAD, 0).otherwise(F.col("copies") - F.col("is_first").cast("bigint"))
    cut_off = (F.col("is_first") & (F.col("fault") == CUT_OFF)).cast("bigint")
    by_turn = marked.groupBy("who", "turn").agg(
        F.sum(blank).alias("blank"), F.sum(again).alias("duplicate"), F.sum(cut_off).alias("truncated")
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("who").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def repair_conversations(turns: DataFrame) -> Repair:
    """Cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text).

    Rows are taken by turn, nulls first; rows of one turn by role and text. Null roles and
    texts count as one space; rows with a null conv_id are a conversation. Other columns
    are ignored; no rows give no conversations. The faults of a row are, the first that
    holds: blank, duplicate (its role and text were seen before), truncated.

    Rows are dealt out by range of conversation, turn, role and beginning of the text, so
    a conversation of any length is spread over tasks, in segments. One task sees the
    spans of all segments of a conversation (16 bytes a row), never its texts.
    """
    marked = stage(marked_turns(turns), "turns")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "who", "turn", "role")]
    dealt = marked.select("conv_id", "who", "turn", "role", "text", "copies", "is_first", "fault")
    dealt = dealt.repartitionByRange(*order, F.substring("text", 1, DEALT_CHARACTERS).asc())
    sorted_rows = dealt.sortWithinPartitions(*order, "text")
    keys = T.StructType([marked.schema["conv_id"], T.StructField("who", T.StringType())])
    segments = stage(_in_arrow(sorted_rows, _segment_batches, T.StructType([*keys, *SEGMENTS])), "segments")

    whole = segments.where("whole").select(*segments.columns[:12])
    cut = segments.where("not whole")
    chosen = cut.groupBy("who").applyInPandas(
        _choose,
        "who string, part int, number bigint, state int, audit string, cost bigint",
    )
    parts = cut.select(*[c for c in whole.columns if c not in ("audit", "cost")])
    chosen_parts = parts.join(chosen, ["who", "part", "number"]).select(*whole.columns, "state")
    mended = stage(_in_arrow(chosen_parts, _edit_batches, whole.schema), "mended")

    ends = ["illegal", "cost", "audit"]
    of_whole = whole.select("who", *ends, F.sha2(_lines(), 256).alias("repaired_sha256"))
    in_order = (
        mended.withColumn("lines", _lines())
        .select("who", "part", "number", "first", "last", *ends, "lines")
        .repartition("who")
        .sortWithinPartitions("who", "part", "number")
    )
    of_cut = _in_arrow(in_order, _hash_batches, of_whole.schema)
    ids = marked.groupBy("who").agg(F.first("conv_id").alias("conv_id"))
    reports = ids.join(_counts(marked), "who").join(of_whole.unionByName(of_cut), "who")
    made = whole.unionByName(mended).select(
        "conv_id",
        "part",
        "number",
        F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"),
    )
    return Repair(
        reports.select("conv_id", "gaps", "blank", "duplicate", "truncated", *ends, "repaired_sha256"),
        made.select(
            "conv_id",
            "part",
            "number",
            "place",
            F.col("row.roles").alias("role"),
            F.col("row.texts").alias("text"),
        ),
    )


def _in_arrow(df: DataFrame, function, schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    return df.mapInArrow(functools.partial(function, schema=to_arrow_schema(schema)), schema)


def damage_turns(conversations: DataFrame) -> DataFrame:
    """Conversations with damage that depends on id and turn alone, to test repairs.

    Of twenty equally frequent cases, five do something: the row goes, its text becomes
    empty or loses its ``.!?``, the row is there twice, its role becomes user. Nulls
    are one space.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    case = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"])) % 20
    copies = F.when(case == 0, F.array().cast("array<int>")).when(case == 3, F.array(F.lit(1), F.lit(2)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(text["role"]).alias("role"),
        F.when(case == 1, "")
        .when(case == 2, F.translate(text["text"], ".!?", ""))
        .otherwise(text["text"])
        .alias("text"),
        F.explode(copies.otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """A report for every conv_id of ``conversations`` after damage and repair.

    A conversation that lost all its rows has zeros, an empty audit and the hash of an
    empty text.
    """
    reports = repair_conversations(damage_turns(conversations)).reports
    ids = conversations.groupBy("conv_id").agg(F.lit(1).alias("there")).select("conv_id")
    found = ids.join(
        reports.withColumnRenamed("conv_id", "repaired_id"),
        F.col("conv_id").eqNullSafe(F.col("repaired_id")),
        "left",
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
