"""Repeatable sample of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.times import format_action_time
from clickloom.operators.sessions import session_term_lists

# Leading digits of a digest that group sessions: 16 ** 4 groups of nearly equal size.
GROUP_DIGITS = 4


def pick_sessions(sessions: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """Exactly ``size`` sessions (all, if there are fewer), the same on every run.

    Sessions are ranked by a seeded digest. Counts per leading digits tell which groups
    are in the sample and how much of the group at the cut is; sessions are then ranked
    within their group. The counts, at most 65,536 rows, are what is summed in one task
    and broadcast.
    """
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col("session_id")))
    ranked = sessions.withColumn("_rank", rank).withColumn(
        "_group", F.substring("_rank", 1, GROUP_DIGITS)
    )
    counts = ranked.groupBy("_group").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_group"))
    before = counts.select("_group", (upto - F.col("_n")).alias("_before")).where(F.col("_before") < size)
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_rank", "session_id"))
    inside = ranked.join(F.broadcast(before), "_group").withColumn("_place", place)
    return inside.where(F.col("_before") + F.col("_place") <= size).select(*sessions.columns)


def sample_sessions(
    sessions: DataFrame, actions: DataFrame, task_id: str, size: int = 100, seed: int = 0
) -> DataFrame:
    """Sampled sessions with start time and lists, which are made for the sample only."""
    picked = pick_sessions(sessions, size, seed).select("session_id", "start_time")
    theirs = actions.join(picked, "session_id")
    lists = session_term_lists(theirs, by=["session_id", "start_time"], keep_empty=True)
    return lists.select(
        F.lit(task_id).alias("task_id"),
        "session_id",
        format_action_time(F.col("start_time")).alias("start_time"),
        "search_keywords",
        "click_categories",
    )
