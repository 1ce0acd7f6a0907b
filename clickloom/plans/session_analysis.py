"""The session pipeline: raw actions and users to filtered sessions and what is made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions.times import format_action_time
from clickloom.operators.distribution import observe_counters
from clickloom.operators.sessions import filtered_sessions, with_term_lists
from clickloom.session_filter import SessionFilter

FULL_INFO = (
    "session_id",
    "user_id",
    "search_keywords",
    "click_categories",
    "visit_length",
    "step_length",
    "start_time",
    "age",
    "professional",
    "sex",
    "city",
)


def session_full_info(
    actions: DataFrame,
    users: DataFrame,
    params: SessionFilter | None = None,
    *,
    wrap_day: bool = False,
) -> DataFrame:
    """Filtered sessions with lists and user attributes; start time in the stored format.

    Lists are made for the sessions that pass only.
    """
    passing = filtered_sessions(actions, users, params, wrap_day=wrap_day)
    full = with_term_lists(passing, actions)
    return full.withColumn("start_time", format_action_time(F.col("start_time"))).select(*FULL_INFO)


def counted_full_info(
    actions: DataFrame,
    users: DataFrame,
    params: SessionFilter | None = None,
    *,
    wrap_day: bool = False,
    compat_zero_bucket: bool = False,
) -> tuple[DataFrame, Observation]:
    """``session_full_info``, and an observation that its first action fills with all counters.

    ``distribution.observed_counters`` reads it: totals and both histograms.
    """
    info = session_full_info(actions, users, params, wrap_day=wrap_day)
    return observe_counters(info, compat_zero_bucket=compat_zero_bucket)


__all__ = ["FULL_INFO", "counted_full_info", "filtered_sessions", "session_full_info"]
