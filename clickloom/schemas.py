"""Column layouts of the model tables and of the persisted results."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Table layouts shared with existing data.
# The stored action table keeps `date` and `action_time` as text.
STORED_ACTIONS = _struct(
    ("date", T.StringType()),
    ("user_id", T.LongType()),
    ("session_id", T.StringType()),
    ("page_id", T.LongType()),
    ("action_time", T.StringType()),
    ("search_keyword", T.StringType()),
    ("click_category_id", T.LongType()),
    ("click_product_id", T.LongType()),
    ("order_category_ids", T.StringType()),
    ("order_product_ids", T.StringType()),
    ("pay_category_ids", T.LongType()),
    ("pay_product_ids", T.LongType()),
    ("city_id", T.LongType()),
)

USERS = _struct(
    ("user_id", T.LongType()),
    ("username", T.StringType()),
    ("name", T.StringType()),
    ("age", T.LongType()),
    ("professional", T.StringType()),
    ("city", T.StringType()),
    ("sex", T.StringType()),
)

PRODUCTS = _struct(
    ("product_id", T.LongType()),
    ("product_name", T.StringType()),
    ("extend_info", T.StringType()),
)

# Actions as the operators read them: real date and time columns.
ACTIONS = T.StructType(
    [
        T.StructField(
            f.name,
            {"date": T.DateType(), "action_time": T.TimestampNTZType()}.get(f.name, f.dataType),
            True,
        )
        for f in STORED_ACTIONS
    ]
)

# Result tables.
SAMPLE = _struct(
    ("task_id", T.StringType()),
    ("session_id", T.StringType()),
    ("start_time", T.StringType()),
    ("search_keywords", T.StringType()),
    ("click_categories", T.StringType()),
)

TOP_CATEGORIES = _struct(
    ("task_id", T.StringType()),
    ("category_id", T.LongType()),
    ("click_count", T.LongType()),
    ("order_count", T.LongType()),
    ("pay_count", T.LongType()),
)


def ratio_schema(columns: list[str]) -> T.StructType:
    """Layout of a stored ratio table: task, session count, one double per bucket."""
    return _struct(
        ("task_id", T.StringType()),
        ("session_count", T.LongType()),
        *((name, T.DoubleType()) for name in columns),
    )
