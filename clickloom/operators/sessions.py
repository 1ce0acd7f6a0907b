"""Session summaries, their keyword and category lists, users and filters."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import join_values
from clickloom.functions.times import elapsed_seconds, use_order
from clickloom.operators.ordering import CROWDED_ROWS, number_in_place, number_rows
from clickloom.session_filter import SessionFilter, parse_list

# List columns of a session and the action column each is made of.
TERM_LISTS = {"search_keywords": "search_keyword", "click_categories": "click_category_id"}

# Terms of a chunk of a list.
CHUNK_TERMS = 10_000


def has_search() -> Column:
    return F.col("search_keyword").isNotNull()


def has_click() -> Column:
    """-1 means no click; null gives null, which passes no filter either."""
    return F.col("click_category_id") != -1


def has_order() -> Column:
    return F.col("order_category_ids").isNotNull()


def has_pay() -> Column:
    return F.col("pay_category_ids").isNotNull()


def action_kinds(actions: DataFrame) -> DataFrame:
    """Number of actions of each kind; ``none`` is a page view only."""
    kinds = {"search": has_search(), "click": has_click(), "order": has_order(), "pay": has_pay()}
    known = F.coalesce(has_search() | has_click() | has_order() | has_pay(), F.lit(False))
    counts = actions.agg(
        *[F.count_if(test).alias(kind) for kind, test in kinds.items()],
        F.count_if(~known).alias("none"),
    )
    return counts.unpivot([], [*kinds, "none"], "kind", "actions")


def action_order(actions: DataFrame) -> list[str]:
    """Columns that order the actions of a session.

    ``action_id`` parts actions of the same instant. Without it all other columns do,
    so that only equal rows remain interchangeable.
    """
    if "action_id" in actions.columns:
        return ["action_time", "action_id"]
    rest = [c for c in actions.columns if c not in ("session_id", "action_time")]
    return ["action_time", *rest]


def session_actions(
    actions: DataFrame, crowded_rows: int = CROWDED_ROWS, *, in_place: bool = False
) -> DataFrame:
    """Every action with its step number within the session.

    ``in_place`` is for actions stored by session, without large ones: no row moves.
    """
    if in_place:
        return number_in_place(actions, "session_id", action_order(actions), "step")
    return number_rows(actions, "session_id", action_order(actions), "step", crowded_rows)


def session_summary(
    actions: DataFrame, *, wrap_day: bool = False, flags: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per session: user, visit length in seconds, step count, start and end.

    ``flags`` adds boolean columns that tell whether any action meets a condition; they
    ride on the same aggregate. The user is that of the earliest action, at one instant
    that of the smallest action_id (without one, the smallest user); two users in one
    session are a data error that ``mixed_user_sessions`` finds.
    """
    flags = flags or {}
    tie = "action_id" if "action_id" in actions.columns else "user_id"
    summary = actions.groupBy("session_id").agg(
        F.min_by("user_id", use_order(F.col("action_time"), F.col(tie))).alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count("*").alias("step_length"),
        *[F.bool_or(F.coalesce(test, F.lit(False))).alias(name) for name, test in flags.items()],
    )
    visit_length = elapsed_seconds(F.col("start_time"), F.col("end_time"), wrap_day)
    return summary.select(
        "session_id",
        "user_id",
        visit_length.alias("visit_length"),
        "step_length",
        "start_time",
        "end_time",
        *flags,
    )


def mixed_user_sessions(actions: DataFrame) -> DataFrame:
    """Number of sessions, and of sessions with actions of more than one user."""
    spans = actions.groupBy("session_id").agg(
        F.min("user_id").alias("low"), F.max("user_id").alias("high")
    )
    return spans.agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("low") != F.col("high")).alias("mixed_user_sessions"),
    )


def session_terms(
    actions: DataFrame, *lists: str, by: Sequence[str] = ("session_id",), keep_empty: bool = False
) -> DataFrame:
    """Distinct searched keywords and clicked categories, with when each came first.

    One row per (session, list, term). Repeats are combined before the shuffle, so a
    large session sends no more rows per task than it has different terms.
    ``keep_empty`` keeps a row with a null term for actions without one.
    """
    return _terms(actions, *lists, by=by, keep_empty=keep_empty).drop("first_use")


def _terms(
    actions: DataFrame, *lists: str, by: Sequence[str] = ("session_id",), keep_empty: bool = False
) -> DataFrame:
    """Session terms with their place in the order of use, by time and action_id."""
    lists = lists or tuple(TERM_LISTS)
    number = F.col("action_id") if "action_id" in actions.columns else None
    terms = {
        "search_keywords": F.when(F.col("search_keyword") != "", F.col("search_keyword")),
        "click_categories": F.when(has_click(), F.col("click_category_id").cast("string")),
    }
    if not keep_empty:
        present = {"search_keywords": has_search(), "click_categories": has_click()}
        actions = actions.where(reduce(operator.or_, [present[name] for name in lists]))
    stacked = actions.select(
        *by,
        "action_time",
        use_order(F.col("action_time"), number).alias("use"),
        F.stack(
            F.lit(len(lists)), *[part for name in lists for part in (F.lit(name), terms[name])]
        ).alias("list", "term"),
    )
    if not keep_empty:
        stacked = stacked.where("term is not null")
    return stacked.groupBy(*by, "list", "term").agg(
        F.min("action_time").alias("first_seen"), F.min("use").alias("first_use")
    )


def session_term_lists(
    actions: DataFrame, *lists: str, by: Sequence[str] = ("session_id",), keep_empty: bool = False
) -> DataFrame:
    """Comma-separated distinct terms per session, in order of first use.

    Terms first used at the same instant are put in the order of their actions, without
    action ids in text order. Sessions without any term are left out unless
    ``keep_empty``. ``by`` may add columns that are constant within a session.
    """
    lists = lists or tuple(TERM_LISTS)
    found = F.col("term").isNotNull()
    ordered = [
        F.array_sort(
            F.collect_list(F.when(found & (F.col("list") == name), F.struct("first_use", "term")))
        ).alias(name)
        for name in lists
    ]
    terms = _terms(actions, *lists, by=by, keep_empty=keep_empty)
    return (
        terms.groupBy(*by)
        .agg(*ordered)
        .select(*by, *[join_values(F.col(name)["term"]).alias(name) for name in lists])
    )


def session_term_chunks(
    actions: DataFrame, *lists: str, size: int = CHUNK_TERMS, crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """Lists of ``session_term_lists`` in chunks of ``size`` terms, numbered from 0.

    One row per (session, list, chunk), so no cell grows with the session, and a session
    with very many terms is numbered by several tasks. Chunks joined in order are the list.
    """
    numbered = number_rows(
        _terms(actions, *lists), ["session_id", "list"], ["first_use", "term"], "place", crowded_rows
    )
    chunk = F.floor((F.col("place") - 1) / size).alias("chunk")
    in_order = F.array_sort(F.collect_list(F.struct("place", "term")))
    return numbered.groupBy("session_id", "list", chunk).agg(
        F.count("*").alias("n_terms"), join_values(in_order["term"]).alias("terms")
    )


def with_term_lists(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Add both lists to session rows; a session without a term gets an empty list.

    Actions of other sessions are left out before lists are made.
    """
    theirs = actions.join(sessions.select("session_id"), "session_id", "left_semi")
    lists = session_term_lists(theirs)
    joined = sessions.join(lists, "session_id", "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit("")) for name in TERM_LISTS})


def join_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with the age, profession, sex and city of their user.

    Sessions of unknown users drop out; a user listed twice doubles their sessions.
    """
    attributes = users.select("user_id", "age", "professional", "sex", "city")
    return sessions.join(attributes, "user_id")


def user_condition(params: SessionFilter) -> Column:
    """Conditions on user attributes; a null age fails."""
    condition = F.col("age").between(params.start_age, params.end_age)
    for column, text in (("professional", params.professionals), ("city", params.cities)):
        values = parse_list(text)
        if values:
            condition = condition & F.col(column).isin(*values)
    if params.sex:
        condition = condition & (F.col("sex") == params.sex)
    return condition


def action_flags(params: SessionFilter) -> dict[str, Column]:
    """Conditions on the actions of a session, as flags of its summary."""
    flags = {}
    keywords = parse_list(params.keywords)
    if keywords:
        flags["has_keyword"] = F.col("search_keyword").isin(*keywords)
    categories = [int(c) for c in parse_list(params.category_ids)]
    if categories:
        flags["has_category"] = has_click() & F.col("click_category_id").isin(*categories)
    return flags


def filtered_sessions(
    actions: DataFrame,
    users: DataFrame,
    params: SessionFilter | None = None,
    *,
    wrap_day: bool = False,
) -> DataFrame:
    """Sessions with user attributes that meet all conditions of ``params``."""
    params = params or SessionFilter()
    flags = action_flags(params)
    sessions = session_summary(actions, wrap_day=wrap_day, flags=flags)
    for name in flags:
        sessions = sessions.where(F.col(name))
    return join_users(sessions.drop(*flags), users.where(user_condition(params)))
