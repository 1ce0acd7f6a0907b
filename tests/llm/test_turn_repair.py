from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from clickloom.llm import queries, turn_repair

BLANK = re.compile(r"[\x20\x09-\x0D]*")
RIGHT = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def all_repairs(rows):
    """(cost, audit) of every way to edit (initial, fault) rows, with few insertions."""
    inserts = ["", "u", "a", "ua", "au"]
    options = []
    for initial, fault in rows:
        extra = 5 if fault == turn_repair.CUT_OFF else 0
        ways = [(2, "D", "")]
        if fault != turn_repair.BAD:
            ways += [(extra, "K", initial), (extra + 1, "R", "u"), (extra + 1, "R", "a")]
        options += [[(5 * len(i), "I" * len(i), i) for i in inserts], ways]
    options.append([(5 * len(i), "I" * len(i), i) for i in inserts])
    for picks in itertools.product(*options):
        if RIGHT.fullmatch("".join(p[2] for p in picks)):
            yield sum(p[0] for p in picks), "".join(p[1] for p in picks)


@functools.cache
def plain_best(rows, state=""):
    """(cost, audit) by trying what can be done with the first row; state: last letter."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
    found = []
    if not rows:
        found += [(0, "")] if state in ("", "a") else []
        letter = "ua"["ua".index(after[-1])]
        if state in ("s", "u"):
            cost, audit = plain_best(rows, letter)
            found.append((cost + 5, "I" + audit))
        return min(found)
    (initial, fault), rest = rows[0], rows[1:]
    extra = 5 if fault == turn_repair.CUT_OFF else 0

    def add(cost, edit, following, letter):
        more, audit = plain_best(following, letter)
        found.append((cost + more, edit + audit))

    add(2, "D", rest, state)
    letter = after[-1]
    if fault != turn_repair.BAD:
        if initial in [*after]:
            add(extra, "K", rest, initial)
        add(extra + 1, "R", rest, letter)
        # One insertion, or two, and then this row.
        for count in (1, 2):
            at, cost = state, 0
            for _ in range(count):
                at, cost = {"": "u", "s": "u", "u": "a", "a": "u"}[at], cost + 5
            into = {"": "su", "s": "u", "u": "a", "a": "u"}[at]
            if initial in [*into]:
                more, audit = plain_best(rest, initial)
                found.append((cost + extra + more, "I" * count + "K" + audit))
    return min(found)


def random_rows(rng, size):
    return [(rng.choice("uuaasx "), rng.choice([0, 0, 0, 1, 2])) for _ in range(size)]


def test_against_all_repairs():
    rng = random.Random(1)
    for size in (0, 1, 1, 2, 2, 2, 2, 3, 3, 3):
        rows = random_rows(rng, size)
        assert turn_repair.repair(rows) == min(all_repairs(rows)), rows
        assert plain_best(tuple(rows)) == min(all_repairs(rows)), rows


def test_against_plain_recursion():
    rng = random.Random(2)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(0, 14))
        assert turn_repair.repair(rows) == plain_best(tuple(rows)), rows


def test_segments_join_to_the_same_repair():
    rng = random.Random(3)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(1, 20))
        cuts = sorted({0, len(rows), *(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 4)))})
        segments = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        chosen = turn_repair.join_spans([turn_repair.spans(s) for s in segments])
        assert "".join(audit for _, audit in chosen) == plain_best(tuple(rows))[1], rows


def test_ropes_compare_as_text():
    rng = random.Random(4)
    for _ in range(500):
        texts = ["".join(rng.choices("DI", k=rng.randint(0, 6))) for _ in range(2)]
        ropes = []
        for text in texts:
            cut = rng.randint(0, len(text))
            ropes.append(turn_repair.Rope(text[:cut], turn_repair.Rope(text[cut:])))
        assert (ropes[0] < ropes[1], ropes[0] == ropes[1]) == (texts[0] < texts[1], texts[0] == texts[1])


def damaged(rows):
    """Rows after damage, from (conv_id, turn, role, text)."""
    for conversation, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conversation, turn)]
        case = zlib.crc32(":".join(shown).encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        yield from [(conversation, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def plain_report(rows):
    """Report of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not solid else "duplicate" if (role, text) in seen
            else "truncated" if solid[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    kinds = {"": 0, "truncated": 1, "blank": 2, "duplicate": 2}
    cost, audit = plain_best(tuple((i, kinds[f]) for i, f in zip(initials, faults)))
    lines, state, left = [], "", iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        letter = row[2][:1] if edit == "K" else {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        role = row[2] if edit == "K" else {"u": "user", "a": "assistant"}[letter]
        lines.append(f"{role}:{row[3] if row else ''}")
        state = letter
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counted = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counted, illegal, cost, audit, digest), lines


def plain_reports(rows):
    rows = list(rows)
    left = list(damaged(rows))
    return sorted(
        ((c, *plain_report([r for r in left if r[0] == c])[0]) for c in {r[0] for r in rows}), key=str
    )


def reports(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def conversations(spark, rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def odd_conversations():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "", " \n", "cut off", None, "Ä ö?  ", "x" * 2000 + "."]
    rows = [
        (c, rng.choice([None, *range(-2, 9)]), rng.choice(["user", "assistant", "system", None, "", "uncle"]),
         rng.choice(texts))
        for c in [*range(60), None]
        for _ in range(rng.randint(1, 9))
    ]
    return rows + rows[:40]


def test_odd_rows(spark):
    rows = odd_conversations()
    found = turn_repair.repair_damaged(conversations(spark, rows))
    assert reports(found) == plain_reports(rows)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert [kind for _, kind in found.dtypes] == ["bigint"] * 7 + ["string"] * 2


def test_no_rows_and_lost_rows(spark):
    assert turn_repair.repair_damaged(conversations(spark, [])).count() == 0
    gone = next(t for t in range(1000) if not list(damaged([(1, t, "user", "Yes.")])))
    found = reports(turn_repair.repair_damaged(conversations(spark, [(1, gone, "user", "Yes.")])))
    assert found == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_clashing_columns(spark):
    rows = odd_conversations()[:50]
    extra = "who string, part string, number string, copies string, is_first string, fault string, audit string"
    wide = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], f"{SCHEMA}, {extra}")
    assert reports(turn_repair.repair_damaged(wide)) == plain_reports(rows)


@pytest.mark.parametrize("limit", [1, 3, 512])
def test_one_long_conversation(spark, monkeypatch, limit):
    monkeypatch.setattr(turn_repair, "SEGMENT_ROWS", limit)
    rng = random.Random(7)
    texts = ["Yes.", "No!", "", "cut off", *[f"Text {n}." for n in range(200)]]
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(1, t, rng.choice(roles), rng.choice(texts)) for t in range(300)]
    rows += [(2, t, "user", "Yes.") for t in range(5)] + [(3, 0, "user", "Same.")] * 50
    made = turn_repair.repair_conversations(conversations(spark, rows).repartition(5))
    want = {c: plain_report([r for r in rows if r[0] == c]) for c in (1, 2, 3)}
    assert reports(made.reports) == [(c, *w[0]) for c, w in want.items()]
    for conversation, (_, lines) in want.items():
        left = made.turns.where(f"conv_id = {conversation}").orderBy("part", "number", "place").collect()
        assert [f"{r.role}:{r.text}" for r in left] == lines


def test_a_long_conversation_is_spread(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(4000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = turn_repair.repair_conversations(conversations(spark, rows))
        assert made.turns.select("part").distinct().count() == 4
        assert made.reports.select("cost", "gaps").collect() == [(1 * 2 + 1 * 2, 0)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert reports(queries.op13_turn_repair(spark, folder)) == plain_reports(given)
