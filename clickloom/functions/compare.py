"""Field comparison used by reconciliation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def is_timestamp(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TIMESTAMPS)


def comparable(left: T.DataType, right: T.DataType) -> bool:
    """Equal types, or two numbers that Spark can widen to one."""
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return True
    return left.simpleString() == right.simpleString()


def has_inner_map(dtype: T.DataType) -> bool:
    """Whether a map lies inside another type, where its entries cannot be sorted."""
    if isinstance(dtype, T.StructType):
        inner = [f.dataType for f in dtype]
    elif isinstance(dtype, T.ArrayType):
        inner = [dtype.elementType]
    elif isinstance(dtype, T.MapType):
        inner = [dtype.keyType, dtype.valueType]
    else:
        return False
    return any(isinstance(i, T.MapType) or has_inner_map(i) for i in inner)


def orderable(column: Column, dtype: T.DataType) -> Column:
    """Maps cannot be compared; use their sorted entries instead."""
    return F.array_sort(F.map_entries(column)) if isinstance(dtype, T.MapType) else column


def digest_parts(column: Column, dtype: T.DataType) -> list[Column]:
    """What to hash of a value so that different values, nulls too, have different hashes.

    A hash passes over nulls, so they are told apart by a flag, and inside other types by
    the JSON text.
    """
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        column = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return [column, column.isNull()]


def differs(left: Column, right: Column, dtype: T.DataType, nan_differs: bool = False) -> Column:
    """Null equals null, null differs from a value; NaN equals NaN unless ``nan_differs``."""
    unequal = ~left.eqNullSafe(right)
    if nan_differs and isinstance(dtype, _FLOATING):
        unequal = unequal | F.coalesce(F.isnan(left) & F.isnan(right), F.lit(False))
    return unequal
