"""Text expressions: padding, id lists, packed summaries, product attributes, count maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_two(text: Column) -> Column:
    """Put a zero before one-character text; leave any other length as it is."""
    return F.when(F.length(text) == 1, F.concat(F.lit("0"), text)).otherwise(text)


def split_ids(ids: Column) -> Column:
    """``"3,14"`` (or a plain number) to an array of id texts."""
    return F.split(ids.cast("string"), ",\\s*")


def join_values(values: Column) -> Column:
    """Array to comma-separated text without a trailing comma."""
    return F.array_join(values, ",")


def packed_field(packed: Column, name: str) -> Column:
    """Value of ``name`` in old ``k=v|k=v`` summary text, null when absent."""
    return F.try_element_at(F.str_to_map(packed, F.lit("\\|"), F.lit("=")), F.lit(name))


def product_status(extend_info: Column) -> Column:
    """``product_status`` from the attribute JSON.

    Stored attributes may lack the closing brace; a JSON reader gives null on those, so
    the number is then taken by pattern.
    """
    by_pattern = F.regexp_extract(extend_info, r'"product_status":\s*([0-9]+)', 1)
    return F.coalesce(
        F.get_json_object(extend_info, "$.product_status"),
        F.nullif(by_pattern, F.lit("")),
    ).cast("int")


def decode_counts(json_text: Column) -> Column:
    """Count map kept as JSON text to a map column."""
    return F.from_json(json_text, "map<string,bigint>")


def encode_counts(counts: Column) -> Column:
    """Map of counts to JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(counts))))
