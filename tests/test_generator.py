from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from clickloom.functions.text import product_status
from clickloom.operators.sessions import mixed_user_sessions, session_summary
from clickloom.plans.mock_load import load_mock_tables, mock_tables
from clickloom.plans.session_analysis import filtered_sessions
from clickloom.schemas import PRODUCTS, STORED_ACTIONS, USERS
from clickloom.sources import generator
from clickloom.sources.tables import ACTION_TABLE, PRODUCT_TABLE, USER_TABLE, scan, typed_actions
from helpers import rows


def types(schema):
    return [(f.name, f.dataType) for f in schema]


def test_actions_have_the_stored_layout_and_domains(spark):
    df = generator.generate_actions(generator.slots(spark, 10), seed=5).cache()
    assert types(df.schema) == types(STORED_ACTIONS)
    typed = typed_actions(df)
    assert df.select("session_id").distinct().count() == 100
    row = df.agg(
        F.min("user_id") >= 1,
        F.max("user_id") <= 100,
        F.min("page_id") >= 1,
        F.max("page_id") == 100,
        F.min("click_category_id") == -1,
        F.max("click_category_id") <= 100,
        F.max("city_id") <= 10,
        F.count_distinct("search_keyword") == 10,
        F.min(F.length("session_id")) == 32,
        F.max("date") == str(datetime.date.today()),
    ).first()
    assert all(row)
    kinds = (
        (F.col("search_keyword").isNotNull()).cast("int")
        + (F.col("click_category_id") >= 0).cast("int")
        + (F.col("order_category_ids").isNotNull()).cast("int")
        + (F.col("pay_category_ids").isNotNull()).cast("int")
    )
    assert rows(df.select(kinds.alias("n")).distinct()) == [(1,)]
    assert df.where(F.col("action_time").rlike(r" 0\d:")).count() == 0
    summary = session_summary(typed).agg(
        F.min("step_length"), F.max("step_length"), F.max("visit_length")
    )
    low, high, visit = summary.first()
    assert 20 <= low <= high <= 100 and visit < 3600
    assert rows(mixed_user_sessions(typed)) == [(100, 0)]
    df.unpersist()


def test_same_rows_under_any_partitioning(spark):
    slots = generator.slots(spark, 4)
    one = generator.generate_actions(slots, seed=5, date="2024-01-01")
    two = generator.generate_actions(slots.repartition(3), seed=5, date="2024-01-01")
    other = generator.generate_actions(slots, seed=6, date="2024-01-01")
    assert rows(one) == rows(two) != rows(other)


def test_users_and_products(spark):
    tables = mock_tables(spark, seed=2)
    people, goods = tables[USER_TABLE], tables[PRODUCT_TABLE]
    assert types(people.schema) == types(USERS)
    assert types(goods.schema) == types(PRODUCTS)
    low, high, n = people.agg(F.min("user_id"), F.max("user_id"), F.count("*")).first()
    assert (low, high, n) == (0, 99, 100)
    assert people.where("age between 10 and 60 and sex in ('Male', 'Female')").count() == 100
    status = goods.select(product_status(F.col("extend_info"))).distinct()
    assert rows(status) == [(0,), (1,)]


def test_load_and_analyse(spark):
    for _ in range(2):  # replacing an existing table works too
        load_mock_tables(spark, n_users=5, sessions_per_user=2, date="2024-01-01")
    actions = typed_actions(scan(spark, ACTION_TABLE))
    assert actions.select("session_id").distinct().count() == 10
    assert scan(spark, USER_TABLE, "user_id", "age").columns == ["user_id", "age"]
    passing = filtered_sessions(actions, scan(spark, USER_TABLE))
    assert passing.count() <= 10
