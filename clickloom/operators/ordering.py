"""Order within a key, also when one key holds a large part of all rows.

A large key is cut into ranges of the order columns, between values taken from a sample of
its rows. A range goes to one task; rows are ordered within it, and the sizes of a key's
earlier ranges, or the first row of its next one, tell how it goes on across ranges. Keys
of ordinary size are one range. The plan is the same for any data and any sortable types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that a range of a large key has, about.
CROWDED_ROWS = 1_000_000

# Sampled rows for each range; the more, the more even the ranges.
SAMPLES = 16

# Ranges of all keys together, at most about; beyond that they grow. Bounds what is broadcast.
RANGES = 10_000

RANGE = "_range"


def range_ends(
    df: DataFrame, key: Sequence[str], order: Sequence[str], crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """(_of, _ends): first order values of the second and later ranges of each large key.

    The sample takes rows by a hash of key and order, so repeated work gives the same
    ranges. One row in a million becomes an end, and fewer where there are very many.
    """
    every = max(1, crowded_rows // SAMPLES)
    step = max(1, crowded_rows // every)
    taken = F.pmod(F.xxhash64(*key, *order), F.lit(every)) == 0
    sample = df.where(taken).select(F.struct(*key).alias("_of"), F.struct(*order).alias("_at")).distinct()
    of_key = Window.partitionBy("_of")
    placed = sample.select(
        "_of",
        "_at",
        F.row_number().over(of_key.orderBy("_at")).alias("_n"),
        F.count("*").over(of_key).alias("_all"),
    )
    # Not so close to the end that the last range would be small.
    ends = placed.where((F.col("_n") % step == 0) & (2 * (F.col("_all") - F.col("_n")) >= step))
    ends = ends.withColumn("_thin", F.ceil(F.count("*").over(Window.partitionBy()) / RANGES))
    ends = ends.where(F.col("_n") / step % F.col("_thin") == 0)
    return ends.groupBy("_of").agg(F.array_sort(F.collect_list("_at")).alias("_ends"))


def _place(value: Column, ends: Column) -> Column:
    """How many of the sorted ends are not above a value, found by halving."""
    powers = [1 << n for n in range(RANGES.bit_length(), -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(power) for power in powers]),
        F.lit(0),
        lambda at, power: F.when(F.get(ends, at + power - 1) <= value, at + power).otherwise(at),
    )


def with_ranges(
    df: DataFrame, key: Sequence[str], order: Sequence[str], crowded_rows: int = CROWDED_ROWS
) -> DataFrame:
    """Rows with the number of their range, in the order of ranges; null if the key has one."""
    ends = range_ends(df, key, order, crowded_rows)
    joined = df.join(F.broadcast(ends), F.struct(*key) == F.col("_of"), "left")
    place = F.when(F.col("_ends").isNotNull(), _place(F.struct(*order), F.col("_ends")))
    return joined.select(*df.columns, place.alias(RANGE))


def _spread(ranged: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each range in one partition. Stated, or a key's ranges could stay where the key is."""
    return ranged.repartition(*key, RANGE)


def number_rows(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    name: str,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """Add each row's 1-based position within its key; nulls are a key and come first."""
    keys = [key] if isinstance(key, str) else list(key)
    ranged = with_ranges(df, keys, order, crowded_rows)
    rank = F.row_number().over(Window.partitionBy(*keys, RANGE).orderBy(*order))
    ranked = _spread(ranged, keys).withColumn("_rank", rank)
    earlier = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.where(F.col(RANGE).isNotNull())
        .groupBy(F.struct(*keys).alias("_of"), F.col(RANGE).alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_of", "_part", F.sum("_n").over(earlier).alias("_before"))
        .where("_before > 0")
    )
    position = F.col("_rank") + F.coalesce("_before", F.lit(0))
    same = (F.col(RANGE) == F.col("_part")) & (F.struct(*keys) == F.col("_of"))
    return ranked.join(F.broadcast(before), same, "left").select(
        *df.columns, position.cast("bigint").alias(name)
    )


def number_in_place(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """As ``number_rows``, for rows whose keys each lie in one partition and are not large."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn(name, position.cast("bigint"))


def with_next(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """(value, next value within the key) for every row; the last of a key has null."""
    keys = [key] if isinstance(key, str) else list(key)
    ranged = with_ranges(df, keys, order, crowded_rows)
    within = Window.partitionBy(*keys, RANGE).orderBy(*order)
    ahead = _spread(ranged, keys).select(
        F.struct(*keys).alias("_key"),
        RANGE,
        F.col(value).alias("_value"),
        F.lead(F.struct(F.col(value).alias("_value"))).over(within).alias("_ahead"),
    )
    # The last row of a range goes on with the first row of the key's next range.
    onward = Window.partitionBy("_of").orderBy("_part")
    after = (
        ranged.where(F.col(RANGE).isNotNull())
        .groupBy(F.struct(*keys).alias("_of"), F.col(RANGE).alias("_part"))
        .agg(F.min_by(F.struct(F.col(value).alias("_value")), F.struct(*order)).alias("_head"))
        .select("_of", "_part", F.lead("_head").over(onward).alias("_after"))
        .where("_after is not null")
    )
    same = (F.col(RANGE) == F.col("_part")) & (F.col("_key") == F.col("_of"))
    return ahead.join(F.broadcast(after), same, "left").select(
        F.col("_value").alias(value), F.coalesce("_ahead", "_after")["_value"].alias(name)
    )
