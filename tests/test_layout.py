"""Actions stored by session."""

from __future__ import annotations

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from clickloom.operators import sessions
from clickloom.sources.layout import read_by_session, store_by_session


@pytest.fixture(scope="module")
def actions(spark):
    n = F.col("id")
    return spark.range(2000).select(
        F.when(n % 3 == 0, "hot").when(n % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), n % 97)).alias(
            "session_id"
        ),
        (n % 7).alias("user_id"),
        F.timestamp_seconds(n * 37 % 3000).cast("timestamp_ntz").alias("action_time"),
        n.alias("action_id"),
        F.concat(F.lit("k"), n % 5).alias("search_keyword"),
        F.lit(-1).cast("bigint").alias("click_category_id"),
    )


@pytest.fixture(scope="module", params=[10**6, 300, 0])
def store(spark, actions, request):
    name = f"by_session_{request.param}"
    store_by_session(actions, name, 4, request.param)
    return read_by_session(spark, name), request.param


def test_same_results(store, actions):
    kept, limit = store
    assert kept.usual.count() + kept.large.count() == 2000
    assert kept.large.select("session_id").distinct().count() == {10**6: 0, 300: 1, 0: 99}[limit]
    assert rows(kept.summary()) == rows(sessions.session_summary(actions))
    assert rows(kept.term_lists()) == rows(sessions.session_term_lists(actions))
    steps = kept.steps(crowded_rows=50).select("session_id", "action_id", "step")
    assert rows(steps) == rows(sessions.session_actions(actions).select("session_id", "action_id", "step"))


def test_ordinary_sessions_stay_where_they_are(store):
    kept, _ = store
    for result in (
        sessions.session_summary(kept.usual),
        sessions.session_term_lists(kept.usual),
        sessions.session_actions(kept.usual, in_place=True),
    ):
        assert "Exchange" not in plan(result)
