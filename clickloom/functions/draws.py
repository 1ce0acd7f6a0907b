"""Seeded draws: the same values under any partitioning, on any retry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS_PER_DIGEST = 4


def digest(seed: int, salt: str, *ids: Column) -> Column:
    """32 hex digits determined by seed, salt and row identity."""
    return F.md5(F.concat_ws(":", F.lit(f"{seed}:{salt}"), *[c.cast("string") for c in ids]))


def uniform_int(source: Column, index: int, low: int, high: int | Column) -> Column:
    """Integer in the closed range, from the ``index``-th quarter of a digest."""
    if not 0 <= index < DRAWS_PER_DIGEST:
        raise ValueError(f"a digest holds {DRAWS_PER_DIGEST} draws, not index {index}")
    top = high if isinstance(high, Column) else F.lit(high)
    number = F.conv(F.substring(source, 1 + 8 * index, 8), 16, 10).cast("bigint")
    return number % (top.cast("bigint") - low + 1) + low


def choice(source: Column, index: int, values: Sequence[str]) -> Column:
    position = uniform_int(source, index, 1, len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)
