"""Batch scans: tables, stored-format actions, and sources given as SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import parse_action_time
from clickloom.schemas import ratio_schema

# Names of the model tables.
ACTION_TABLE = "user_visit_action_table"
USER_TABLE = "user_info_table"
PRODUCT_TABLE = "product_info_table"


def scan(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    """Read a table, or only the named columns of it."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def typed_actions(stored: DataFrame) -> DataFrame:
    """Stored actions with ``date`` and ``action_time`` as real date and time."""
    return stored.withColumns(
        {
            "date": F.to_date("date"),
            "action_time": parse_action_time(F.col("action_time")),
        }
    )


def fetch(
    spark: SparkSession, statements: Iterable[str], **frames: DataFrame
) -> list[DataFrame]:
    """One DataFrame per SQL text; any query Spark SQL accepts.

    A DataFrame given by name stands for ``{name}`` in the text.
    """
    return [spark.sql(text, **frames) for text in statements]


def read_ratio_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Ratio rows kept in the Hive default text layout (fields parted by ``\\x01``).

    Files may lie in the folder or in folders of tasks below it.
    """
    reader = spark.read.schema(ratio_schema(columns)).option("recursiveFileLookup", "true")
    return reader.option("sep", "\u0001").option("nullValue", "\\N").option("quote", "").csv(path)
