"""Generate the model tables and store them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clickloom.sinks import replace_table
from clickloom.sources import generator
from clickloom.sources.tables import ACTION_TABLE, PRODUCT_TABLE, USER_TABLE


def mock_tables(
    spark: SparkSession,
    n_users: int = generator.DEFAULT_USERS,
    sessions_per_user: int = generator.SESSIONS_PER_USER,
    seed: int = 0,
    date: str | None = None,
) -> dict[str, DataFrame]:
    slots = generator.slots(spark, n_users)
    return {
        ACTION_TABLE: generator.generate_actions(
            slots, n_users=n_users, sessions_per_slot=sessions_per_user, seed=seed, date=date
        ),
        USER_TABLE: generator.generate_users(slots, seed=seed),
        PRODUCT_TABLE: generator.generate_products(slots, seed=seed),
    }


def load_tables(tables: Mapping[str, DataFrame], folder: str | None = None, prefix: str = "") -> None:
    """Replace stored tables; actions are partitioned by date.

    ``folder`` is where files go, if not into the warehouse; ``prefix`` starts all names.
    """
    for name, df in tables.items():
        path = f"{folder}/{name}" if folder else None
        replace_table(df, prefix + name, "date" if name == ACTION_TABLE else None, path)


def load_mock_tables(spark: SparkSession, **options) -> None:
    """Replace the three model tables by generated ones."""
    load_tables(mock_tables(spark, **options))
