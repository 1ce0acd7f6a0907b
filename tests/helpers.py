"""Small frames and plan access for tests."""

from __future__ import annotations

import datetime

from clickloom.schemas import ACTIONS, USERS

NO_ACTION = {
    "date": datetime.date(2021, 1, 27),
    "user_id": 1,
    "session_id": "s",
    "page_id": 1,
    "action_time": datetime.datetime(2021, 1, 27, 4, 0, 0),
    "search_keyword": None,
    "click_category_id": -1,
    "click_product_id": -1,
    "order_category_ids": None,
    "order_product_ids": None,
    "pay_category_ids": None,
    "pay_product_ids": None,
    "city_id": 0,
}


def at(hour: int, minute: int = 0, second: int = 0, day: int = 27) -> datetime.datetime:
    return datetime.datetime(2021, 1, day, hour, minute, second)


def actions(spark, *rows: dict):
    data = [tuple({**NO_ACTION, **row}[name] for name in ACTIONS.names) for row in rows]
    return spark.createDataFrame(data, ACTIONS)


def users(spark, *rows: dict):
    base = {
        "user_id": 1,
        "username": "u",
        "name": "n",
        "age": 40,
        "professional": "p1",
        "city": "c1",
        "sex": "Male",
    }
    return spark.createDataFrame(
        [tuple({**base, **row}[name] for name in USERS.names) for row in rows], USERS
    )


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    """Physical plan as Spark would run it before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()
