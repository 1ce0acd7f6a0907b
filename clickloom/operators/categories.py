"""Click, order and pay counts per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import split_ids
from clickloom.operators.sessions import has_click, has_order, has_pay

_COUNTS = {"click": "click_count", "order": "order_count", "pay": "pay_count"}


def category_counts(actions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per category (and per ``by`` columns), from one scan of the actions.

    Empty parts of an id list and parts that are no number are passed over.
    """
    ids = F.stack(
        F.lit(3),
        F.lit("click"),
        F.when(has_click(), F.col("click_category_id").cast("string")),
        F.lit("order"),
        F.col("order_category_ids").cast("string"),
        F.lit("pay"),
        F.col("pay_category_ids").cast("string"),
    ).alias("kind", "ids")
    relevant = actions.where(has_click() | has_order() | has_pay())
    named = relevant.select(*by, ids).where("ids is not null and ids <> ''")
    single = named.select(*by, "kind", F.explode(split_ids(F.col("ids"))).alias("id"))
    known = single.withColumn("category_id", F.col("id").try_cast("bigint")).where("category_id is not null")
    return known.groupBy(*by, "category_id").agg(
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in _COUNTS.items()]
    )


def top_categories(
    actions: DataFrame, sessions: DataFrame, task_id: str, limit: int = 10
) -> DataFrame:
    """Categories with most clicks, then orders, then payments, in the given sessions.

    Actions are counted per session and category before they meet the sessions, so a
    large session brings at most one row per category to the join. (Adaptive execution
    would not split such a session: with broadcast users, the other side of the join is
    an aggregate and not a fresh shuffle.)
    """
    per_session = category_counts(actions, by=["session_id"])
    counts = (
        per_session.join(sessions.select("session_id"), "session_id", "left_semi")
        .groupBy("category_id")
        .agg(*[F.sum(name).alias(name) for name in _COUNTS.values()])
    )
    ranking = [F.desc(name) for name in _COUNTS.values()]
    return (
        counts.orderBy(*ranking, "category_id")
        .limit(limit)
        .select(F.lit(task_id).alias("task_id"), "category_id", *_COUNTS.values())
    )
