"""Order within a session, with one session far larger than the others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ordering
from clickloom.operators.pageflow import page_conversion, page_moves
from clickloom.operators.sessions import action_order, session_actions
from helpers import actions, at, plan, rows

WHOLE, SPLIT = 10**9, 20


@pytest.fixture(scope="module")
def skewed(spark):
    """600 of 1000 rows in one session, a third of those at the same instant; null sessions."""
    n = F.col("id")
    return spark.range(1000).select(
        F.when(n % 10 < 6, "hot")
        .when(n % 10 == 6, F.lit(None))
        .otherwise(F.concat(F.lit("s"), n % 37))
        .alias("session_id"),
        F.when(n % 3 == 0, F.lit(500))
        .otherwise(F.pmod(F.hash("id"), F.lit(1000)))
        .alias("action_time"),
        n.alias("action_id"),
        F.pmod(F.xxhash64("id"), F.lit(5)).alias("page_id"),
    )


def brute_force(df):
    groups = {}
    for row in df.collect():
        groups.setdefault(row["session_id"], []).append(row)
    steps, moves = [], []
    for session, members in groups.items():
        members.sort(key=lambda r: (r["action_time"], r["action_id"]))
        for i, row in enumerate(members):
            steps.append((session, row["action_id"], i + 1))
            after = members[i + 1]["page_id"] if i + 1 < len(members) else None
            moves.append((row["page_id"], after))
    return sorted(steps, key=repr), sorted(moves, key=repr)


@pytest.mark.parametrize("limit", [WHOLE, SPLIT])
def test_steps_and_moves(spark, skewed, limit):
    steps, moves = brute_force(skewed)
    got = session_actions(skewed, crowded_rows=limit)
    assert rows(got.select("session_id", "action_id", "step")) == steps
    assert rows(page_moves(skewed, crowded_rows=limit)) == moves


def range_sizes(df, key, order, limit):
    cut = ordering.with_ranges(df, key, order, limit)
    return cut.groupBy(*key, ordering.RANGE).agg(
        F.count("*").alias("rows"), F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")
    ).collect()


def test_the_large_session_is_cut(spark, skewed):
    order = ["action_time", "action_id"]
    whole = range_sizes(skewed, ["session_id"], order, WHOLE)
    assert {r[ordering.RANGE] for r in whole} == {None} and len(whole) == 1 + 1 + 37
    cut = range_sizes(skewed, ["session_id"], order, SPLIT)
    assert sum(r["rows"] for r in cut) == 1000 and max(r["rows"] for r in cut) <= 2 * SPLIT
    # Ranges follow each other in the order of the session.
    seen = {}
    for row in sorted(cut, key=lambda r: r[ordering.RANGE] or 0):
        assert seen.get(row["session_id"], (-1, -1)) < tuple(row["low"])
        seen[row["session_id"]] = tuple(row["high"])


def test_ranges_are_even_for_any_type(spark):
    n = F.col("id")
    df = spark.range(40_000).select(
        F.lit(1).alias("key"),
        F.timestamp_seconds(n % 300).alias("time"),
        F.md5(n.cast("string")).alias("text"),
        F.when(n % 7 > 0, n / 3).alias("number"),
        F.struct((n % 5).alias("a"), F.md5(n.cast("string")).alias("b")).alias("both"),
        F.array(n % 10, n).alias("list"),
    )
    for order in (["text"], ["both"], ["list"], ["time", "text"], ["number", "text"]):
        cut = range_sizes(df, ["key"], order, 2000)
        assert len(cut) >= 12 and max(r["rows"] for r in cut) <= 2 * 2000, order


def test_many_ranges_are_thinned(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGES", 10)
    df = spark.range(5000).select((F.col("id") % 4).alias("key"), "id")
    cut = range_sizes(df, ["key"], ["id"], 20)
    assert 8 <= len(cut) <= 4 + 10
    got = ordering.number_rows(df, "key", ["id"], "n", 20).collect()
    assert sorted(map(tuple, got)) == sorted((n % 4, n, n // 4 + 1) for n in range(5000))


def test_scans_of_a_plan(spark, tmp_path):
    actions(spark, *[{"action_time": at(3, n), "page_id": n} for n in range(9)]).write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    for result in (session_actions(df), page_moves(df)):
        assert plan(result).count("Scan parquet") <= 4
        result.collect()
        final = plan(result).split("Initial Plan")[0]
        assert final.count("Scan parquet") <= 2  # rows and their sample; no key is large


def test_copies(spark):
    """Two thirds of the rows are the same row."""
    n = F.col("id")
    df = spark.range(900).select(
        F.lit("hot").alias("session_id"),
        F.when(n % 3 < 2, 0).otherwise(n).alias("action_time"),
        F.when(n % 3 < 2, 0).otherwise(n).alias("action_id"),
        F.when(n % 3 < 2, 1).otherwise(n % 4).cast("bigint").alias("page_id"),
    )
    for limit in (WHOLE, SPLIT):
        steps, moves = brute_force(df)
        got = session_actions(df, crowded_rows=limit)
        assert rows(got.select("session_id", "action_id", "step")) == steps
        assert rows(page_moves(df, crowded_rows=limit)) == moves


def test_no_job_before_the_action(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    try:
        session_actions(skewed)
        page_conversion(skewed, [1, 2])
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("limit", [WHOLE, SPLIT])
def test_conversion(spark, skewed, limit):
    _, moves = brute_force(skewed)
    got = rows(page_conversion(skewed, [1, 2, 1, 9], crowded_rows=limit))
    expected = []
    for i, (a, b) in enumerate([(1, 2), (2, 1), (1, 9)]):
        views = sum(page == a for page, _ in moves)
        hops = moves.count((a, b))
        expected.append((i + 1, a, b, views, hops, hops / views))
    assert got == expected


def test_page_without_views_has_no_rate(spark):
    df = actions(spark, {"page_id": 1}, {"page_id": 2, "action_time": at(5)})
    got = rows(page_conversion(df, [1, 2, 3, 4]))
    assert got == [(1, 1, 2, 1, 1, 1.0), (2, 2, 3, 1, 0, 0.0), (3, 3, 4, 0, 0, None)]
    with pytest.raises(ValueError):
        page_conversion(df, [1])


def test_order_without_action_id(spark):
    df = actions(spark, {"page_id": 2}, {"page_id": 1}, {"page_id": 3, "action_time": at(3)})
    assert action_order(df)[0] == "action_time" and "page_id" in action_order(df)
    got = session_actions(df).select("page_id", "step")
    assert rows(got) == [(1, 2), (2, 3), (3, 1)]
    assert rows(page_moves(df)) == [(1, 2), (2, None), (3, 1)]
