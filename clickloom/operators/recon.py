"""Reconciliation of two sources by key.

Rows are counted and digested by key first; a digest does not depend on the order of the
rows. What is counted by key needs no more than that. For the mismatch of each column, rows
of keys whose digests differ are joined; the others are sifted out, by a bucket of their
key, before any shuffle. For the table of fields, rows are numbered within their side and
key, by the order of whole rows, and joined by key and number, so that every row of either
side is in the result exactly once and a key with very many rows is spread. Keys are
compared as structs, in which nulls are equal.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.compare import (
    comparable,
    differs,
    digest_parts,
    has_inner_map,
    is_timestamp,
    orderable,
)
from clickloom.operators.ordering import CROWDED_ROWS, number_rows
from clickloom.sources.shared import stage

SIDES = ("source1", "source2")

# Buckets of keys, a power of two; those with a differing key are broadcast.
BUCKETS = 1 << 17


def _position(df: DataFrame, name: str) -> int | None:
    """Position of a column, found as the session resolves names."""
    fold = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    hits = [i for i, column in enumerate(df.columns) if fold(column) == fold(name)]
    if len(hits) > 1:
        raise ValueError(f"key {name!r} is ambiguous in {df.columns}")
    return hits[0] if hits else None


def _key_positions(source1: DataFrame, source2: DataFrame, key: Sequence[str]) -> list[int]:
    positions = []
    for name in key:
        position = _position(source1, name)
        if position is None:
            raise ValueError(f"key {name!r} is not a column of source 1: {source1.columns}")
        if _position(source2, name) not in (None, position):
            raise ValueError(f"key {name!r} has different positions in the two sources")
        positions.append(position)
    return positions


def _check_sources(source1: DataFrame, source2: DataFrame) -> None:
    if len(source1.columns) != len(source2.columns):
        raise ValueError(
            f"sources differ in width: {len(source1.columns)} and {len(source2.columns)} columns"
        )
    for one, two in zip(source1.schema, source2.schema):
        if not comparable(one.dataType, two.dataType):
            raise TypeError(
                f"cannot compare {one.name} ({one.dataType.simpleString()}) "
                f"with {two.name} ({two.dataType.simpleString()})"
            )
        if has_inner_map(one.dataType):
            raise TypeError(f"cannot compare {one.name}: it has a map inside {one.dataType.typeName()}")


def _key_types(source1: DataFrame, source2: DataFrame, keys: Sequence[int]) -> list[T.DataType]:
    """Types that both sides' key columns fit in."""
    sides = [
        df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[f"c{i}" for i in keys])
        for df in (source1, source2)
    ]
    return [field.dataType for field in sides[0].unionAll(sides[1]).schema]


def _rows(df: DataFrame, keys: Sequence[int], types: Sequence[T.DataType], name: str) -> DataFrame:
    """(key, whole row), both as structs."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    row = F.struct(*[orderable(F.col(f.name), f.dataType).alias(f.name) for f in plain.schema])
    key = F.struct(*[F.col(f"c{i}").cast(t).alias(f"k{n}") for n, (i, t) in enumerate(zip(keys, types))])
    return plain.select(key.alias("key"), row.alias(name))


def _digests(rows: DataFrame, name: str, nan_differs: bool) -> list[Column]:
    """Two 64-bit hashes of a row. With ``nan_differs`` a NaN never equals the other side."""
    parts = []
    for field in rows.schema[name].dataType:
        value = F.col(f"{name}.{field.name}")
        parts += digest_parts(value, field.dataType)
        if nan_differs and isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            parts.append(F.when(F.isnan(value), name))
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def _key_counts(one: DataFrame, two: DataFrame, nan_differs: bool) -> DataFrame:
    """(key, n1, n2, d1, e1, d2, e2): rows of each key on either side, and their digests.

    A key with a null in it has no digests, so its rows never count as unequal.
    """
    sides, none = [], F.lit(None).cast("bigint")
    for df, name, first in ((one, "row1", 1), (two, "row2", 0)):
        parts = [F.col(f"key.{field.name}") for field in df.schema["key"].dataType]
        whole = reduce(operator.and_, [part.isNotNull() for part in parts])
        d, e = (F.when(whole, digest) for digest in _digests(df, name, nan_differs))
        sides.append(
            df.select(
                "key",
                *[F.lit(n).cast("bigint").alias(c) for n, c in ((first, "n1"), (1 - first, "n2"))],
                *[(h if first else none).alias(c) for h, c in ((d, "d1"), (e, "e1"))],
                *[(none if first else h).alias(c) for h, c in ((d, "d2"), (e, "e2"))],
            )
        )
    return sides[0].unionAll(sides[1]).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("n1", "n2")],
        *[F.bit_xor(c).alias(c) for c in ("d1", "e1", "d2", "e2")],
    )


@dataclass(frozen=True)
class Reconciliation:
    """Lazy results of comparing two sources; each property is a DataFrame.

    ``rows1`` and ``rows2`` have the key and the whole row of either side; ``counts`` has
    every key with the number and the digests of its rows on each side. A key that a side
    repeats counts as duplicate, not as mismatch.
    """

    rows1: DataFrame
    rows2: DataFrame
    counts: DataFrame
    key: tuple[str, ...]
    columns: tuple[str, ...]
    types1: tuple
    nan_differs: bool = False
    crowded_rows: int = CROWDED_ROWS

    def staged(self) -> Reconciliation:
        """The same, with counts and digests kept in the shared folder, for several outputs."""
        return replace(self, counts=stage(self.counts, "recon"))

    @property
    def _totals(self) -> DataFrame:
        """One row: keys that a side lacks or repeats, and mismatches of each column.

        Only rows whose key is in the bucket of an unequal key are shuffled; there are as
        many buckets at most as are broadcast.
        """
        equal = F.col("d1").eqNullSafe(F.col("d2")) & F.col("e1").eqNullSafe(F.col("e2"))
        bucket = F.xxhash64("key").bitwiseAND(F.lit(BUCKETS - 1))  # never null, so nothing is filtered
        keys = self.counts.withColumn("unequal", (F.col("n1") == 1) & (F.col("n2") == 1) & ~equal)
        found = keys
        buckets = F.broadcast(keys.where("unequal").select(bucket.alias("bucket")).distinct())
        for rows in (self.rows1, self.rows2):
            of_bucket = rows.join(buckets, bucket == F.col("bucket"), "left_semi")
            theirs = of_bucket.withColumnRenamed("key", "of")
            found = found.join(theirs, F.col("unequal") & (F.col("key") == F.col("of")), "left").drop("of")
        tests = {
            "missing_from_src1": F.col("n1") == 0,
            "missing_from_src2": F.col("n2") == 0,
            "duplicate_keys_src1": F.col("n1") > 1,
            "duplicate_keys_src2": F.col("n2") > 1,
        }
        for i, dtype in enumerate(self.types1):
            differing = differs(F.col(f"row1.c{i}"), F.col(f"row2.c{i}"), dtype, self.nan_differs)
            tests[f"m{i}"] = F.col("unequal") & differing
        return found.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])

    @property
    def pairs(self) -> DataFrame:
        """(key, number, row1, row2): every row of either side once, with its number there."""
        one, two = (
            number_rows(df, "key", [row], "number", self.crowded_rows)
            for df, row in ((self.rows1, "row1"), (self.rows2, "row2"))
        )
        return one.join(two, ["key", "number"], "full_outer")

    def _by_column(self, totals: DataFrame, *others: str) -> DataFrame:
        cells = [
            cell for i, name in enumerate(self.columns) for cell in (F.lit(name), F.col(f"m{i}"))
        ]
        column = F.stack(F.lit(len(self.columns)), *cells).alias("column_name", "mismatch")
        return totals.select(column, *others)

    @property
    def missing_keys(self) -> DataFrame:
        """Keys that one side lacks, with the name of that side."""
        lacking = F.when(F.col("n1") == 0, SIDES[0]).when(F.col("n2") == 0, SIDES[1])
        return self.counts.where("n1 = 0 or n2 = 0").select(
            lacking.alias("missing_from"),
            *[F.col(f"key.k{n}").alias(name) for n, name in enumerate(self.key)],
        )

    @property
    def duplicate_keys(self) -> DataFrame:
        """Keys that a side has more than once, with the number of rows on each side."""
        return self.counts.where("n1 > 1 or n2 > 1").select(
            *[F.col(f"key.k{n}").alias(name) for n, name in enumerate(self.key)],
            F.col("n1").alias("rows_source1"),
            F.col("n2").alias("rows_source2"),
        )

    @property
    def field_to_field(self) -> DataFrame:
        """Every row of either side once, both sides of each column next to each other.

        Rows of a repeated key pair up in the order of whole rows. Times become text.
        """
        fields = []
        for i, name in enumerate(self.columns):
            for row, side in zip(("row1", "row2"), SIDES):
                value = F.col(f"{row}.c{i}")
                if is_timestamp(self.types1[i]):
                    value = value.cast("string")
                fields.append(value.alias(f"{name}_{side}"))
        return self.pairs.select(*fields)

    @property
    def mismatch(self) -> DataFrame:
        """(column_name, mismatch): keys on both sides whose values differ."""
        return self._by_column(self._totals)

    @property
    def audit(self) -> DataFrame:
        """Mismatch per column beside the missing and duplicate key counts, in one pass."""
        return self._by_column(
            self._totals,
            "missing_from_src1",
            "missing_from_src2",
            "duplicate_keys_src1",
            "duplicate_keys_src2",
        )


def reconcile(
    source1: DataFrame,
    source2: DataFrame,
    key: str | Sequence[str],
    *,
    nan_differs: bool = False,
) -> Reconciliation:
    """Compare two sources by ``key``; other columns are matched by position."""
    names = [key] if isinstance(key, str) else list(key)
    _check_sources(source1, source2)
    positions = _key_positions(source1, source2, names)
    types = _key_types(source1, source2, positions)
    one, two = (_rows(df, positions, types, row) for df, row in ((source1, "row1"), (source2, "row2")))
    columns = source1.columns
    return Reconciliation(
        rows1=one,
        rows2=two,
        counts=_key_counts(one, two, nan_differs),
        key=tuple(columns[i] for i in positions),
        columns=tuple(columns),
        types1=tuple(f.dataType for f in source1.schema),
        nan_differs=nan_differs,
    )


def duplicate_keys(source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once in one source, and how often."""
    names = [key] if isinstance(key, str) else list(key)
    return source.groupBy(*names).agg(F.count("*").alias("copies")).where("copies > 1")
