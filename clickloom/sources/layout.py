"""Actions stored by session, so that work per session needs no shuffle.

Sessions of ordinary size lie in buckets by session, one task each; the few sessions that
are large themselves are kept apart, in a plain table, and are worked on as usual.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.ordering import CROWDED_ROWS
from clickloom.operators.sessions import session_actions, session_summary, session_term_lists

BUCKETS = 200

LARGE = "_large"


@dataclass(frozen=True)
class SessionStore:
    """Stored actions: of ordinary sessions by bucket, and of large ones."""

    usual: DataFrame
    large: DataFrame

    def per_session(self, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Result of a function that works on each session by itself."""
        return function(self.usual).unionAll(function(self.large))

    def summary(self, **options) -> DataFrame:
        return self.per_session(lambda actions: session_summary(actions, **options))

    def term_lists(self, *lists: str) -> DataFrame:
        return self.per_session(lambda actions: session_term_lists(actions, *lists))

    def steps(self, crowded_rows: int = CROWDED_ROWS) -> DataFrame:
        """Every action with its step number; ordinary sessions are numbered where they lie."""
        usual = session_actions(self.usual, in_place=True)
        return usual.unionAll(session_actions(self.large, crowded_rows))


def store_by_session(
    actions: DataFrame,
    table: str,
    buckets: int = BUCKETS,
    crowded_rows: int = CROWDED_ROWS,
    path: str | None = None,
) -> None:
    """Store actions in ``table``, and those of sessions over ``crowded_rows`` next to it.

    Rows without a session are a session. One shuffle, paid once for all later queries;
    a task writes one bucket as one file.
    """
    sizes = actions.groupBy(F.col("session_id").alias("of")).agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > crowded_rows).select("of")
    same = F.col("session_id").eqNullSafe(F.col("of"))
    usual = actions.join(large, same, "left_anti").repartition(buckets, "session_id")
    writers = {
        table: usual.write.bucketBy(buckets, "session_id").sortBy("session_id"),
        table + LARGE: actions.join(large, same, "left_semi").write,
    }
    for name, writer in writers.items():
        if path:
            writer = writer.option("path", f"{path}/{name}")
        writer.mode("overwrite").saveAsTable(name)


def read_by_session(spark: SparkSession, table: str) -> SessionStore:
    return SessionStore(spark.table(table), spark.table(table + LARGE))
