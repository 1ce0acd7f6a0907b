"""Set operations on rows.

Difference and intersection tag the rows of each side and aggregate on all columns: one
shuffle, nulls equal, and repeated rows combine before it, so copies cause no skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both sides, copies kept; columns are matched by position."""
    return left.unionAll(right)


def _plain(df: DataFrame) -> list[str]:
    return [f"c{i}" for i in range(len(df.columns))]


def _membership(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both sides, columns named by position, and the sides they are on."""
    names = _plain(left)
    sides = [
        df.toDF(*_plain(df)).select("*", F.lit(is_left).alias("in_left"), F.lit(not is_left).alias("in_right"))
        for df, is_left in ((left, True), (right, False))
    ]
    return sides[0].unionAll(sides[1]).groupBy(*names).agg(
        F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right")
    )


def _rows_where(left: DataFrame, right: DataFrame, test: str) -> DataFrame:
    return _membership(left, right).where(test).select(*_plain(left)).toDF(*left.columns)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side lacks."""
    return _rows_where(left, right, "not in_right")


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on both sides."""
    return _rows_where(left, right, "in_left and in_right")
