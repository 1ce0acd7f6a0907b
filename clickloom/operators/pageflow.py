"""Conversion along a page flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordering import CROWDED_ROWS, with_next
from clickloom.operators.sessions import action_order


def page_moves(actions: DataFrame, crowded_rows: int = CROWDED_ROWS) -> DataFrame:
    """(page, next page of the same session) for every action."""
    order = action_order(actions)
    needed = actions.select("session_id", "page_id", *[c for c in order if c != "page_id"])
    return with_next(needed, "session_id", order, "page_id", "next_page", crowded_rows)


def page_conversion(
    actions: DataFrame, flow: Sequence[int], crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """Per adjacent pair of the flow: views of the first page, moves to the second, rate."""
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    pairs = list(zip(flow, flow[1:]))
    page, onward = F.col("page_id"), F.col("next_page")
    totals = page_moves(actions, crowded_rows).agg(
        *[F.count_if(page == a).alias(f"views{i}") for i, (a, _) in enumerate(pairs)],
        *[
            F.count_if((page == a) & (onward == b)).alias(f"hops{i}")
            for i, (a, b) in enumerate(pairs)
        ],
    )
    rows = [
        part
        for i, (a, b) in enumerate(pairs)
        for part in (
            F.lit(i + 1),
            F.lit(a).cast("bigint"),
            F.lit(b).cast("bigint"),
            F.col(f"views{i}"),
            F.col(f"hops{i}"),
        )
    ]
    names = ("step", "from_page", "to_page", "views", "hops")
    flat = totals.select(F.stack(F.lit(len(pairs)), *rows).alias(*names))
    return flat.withColumn("rate", F.try_divide("hops", "views"))
