from __future__ import annotations

import datetime
import hashlib

import pytest
from helpers import actions, at, rows, users
from pyspark.sql import functions as F

from clickloom.functions.times import use_order
from clickloom.operators import sampling, sessions
from clickloom.operators.categories import category_counts, top_categories
from clickloom.operators.products import top_products_by_city
from clickloom.operators.sampling import pick_sessions, sample_sessions
from clickloom.plans.session_analysis import session_full_info
from clickloom.schemas import PRODUCTS, SAMPLE, TOP_CATEGORIES
from clickloom.session_filter import SessionFilter
from clickloom.sources.tables import typed_actions


def test_summary(spark):
    df = actions(
        spark,
        {"action_time": at(4, 35, 6)},
        {"action_time": at(4, 34, 30)},
        {"session_id": "t", "user_id": 2, "action_time": at(23)},
    )
    got = sessions.session_summary(df).select(
        "session_id", "user_id", "visit_length", "step_length", "start_time"
    )
    assert rows(got) == [("s", 1, 36, 2, at(4, 34, 30)), ("t", 2, 0, 1, at(23))]


def test_session_longer_than_a_day(spark):
    df = actions(spark, {"action_time": at(4, day=1)}, {"action_time": at(5, day=2)})
    assert sessions.session_summary(df).first()["visit_length"] == 90_000
    assert sessions.session_summary(df, wrap_day=True).first()["visit_length"] == 3_600


def test_user_of_the_first_action(spark):
    df = actions(spark, {"user_id": 9, "action_time": at(5)}, {"user_id": 3, "action_time": at(4)})
    assert sessions.session_summary(df).first()["user_id"] == 3
    assert rows(sessions.mixed_user_sessions(df)) == [(1, 1)]


def test_terms_are_distinct_whole_values_in_first_seen_order(spark):
    df = actions(
        spark,
        {"click_category_id": 10, "action_time": at(4, 0)},
        {"click_category_id": 1, "action_time": at(4, 1)},
        {"click_category_id": 10, "action_time": at(4, 2)},
        {"search_keyword": "Apple Pie", "action_time": at(4, 3)},
        {"search_keyword": "Apple", "action_time": at(4, 4)},
        {"search_keyword": "", "action_time": at(4, 5)},
        {"search_keyword": "Apple Pie", "action_time": at(4, 6)},
        {"session_id": "none", "click_category_id": None},
    )
    lists = sessions.session_term_lists(df)
    assert rows(lists) == [("s", "Apple Pie,Apple", "10,1")]
    assert rows(sessions.session_term_lists(df, "click_categories")) == [("s", "10,1")]
    summary = sessions.with_term_lists(sessions.session_summary(df).select("session_id"), df)
    assert rows(summary) == [("none", "", ""), ("s", "Apple Pie,Apple", "10,1")]


def test_action_kinds(spark):
    df = actions(
        spark,
        {"search_keyword": "Mugs"},
        {"click_category_id": 3},
        {"click_category_id": None},
        {"order_category_ids": "1"},
        {"pay_category_ids": 1},
        {},
    )
    assert rows(sessions.action_kinds(df)) == [
        ("click", 1),
        ("none", 2),
        ("order", 1),
        ("pay", 1),
        ("search", 1),
    ]


def test_join_drops_unknown_and_repeats_duplicate_users(spark):
    df = actions(spark, {"session_id": "a"}, {"session_id": "b", "user_id": 100})
    people = users(spark, {"city": "c1"}, {"city": "c2"})
    joined = sessions.join_users(sessions.session_summary(df), people).select("session_id", "city")
    assert rows(joined) == [("a", "c1"), ("a", "c2")]


def test_age_range_is_closed_and_null_fails(spark):
    df = actions(spark, *[{"session_id": f"s{n}", "user_id": n} for n in range(6)])
    people = users(
        spark, *[{"user_id": n, "age": a} for n, a in enumerate([29, 30, 50, 51, None, 40])]
    )
    got = sessions.filtered_sessions(df, people).select("session_id")
    assert rows(got) == [("s1",), ("s2",), ("s5",)]


def test_every_filter(spark):
    df = actions(
        spark,
        {"session_id": "a", "search_keyword": "Mugs"},
        {"session_id": "a", "click_category_id": 3, "action_time": at(5)},
        {"session_id": "b", "user_id": 2, "search_keyword": "Mugs"},
        {"session_id": "c", "click_category_id": 3},
        {"session_id": "d"},
    )
    people = users(
        spark, {"user_id": 1}, {"user_id": 2, "professional": "p2", "city": "c2", "sex": "Female"}
    )

    def passing(**params):
        chosen = sessions.filtered_sessions(df, people, SessionFilter(**params))
        return [row[0] for row in rows(chosen.select("session_id"))]

    assert passing() == ["a", "b", "c", "d"]
    assert passing(professionals="p2, p3") == ["b"]
    assert passing(cities="c1") == ["a", "c", "d"]
    assert passing(sex="Female") == ["b"]
    assert passing(keywords="Napkins, Mugs") == ["a", "b"]
    assert passing(category_ids="3, 4") == ["a", "c"]
    assert passing(keywords="Mugs", category_ids="3", sex="Male") == ["a"]
    assert passing(keywords="no such") == []


def test_full_info(spark):
    df = actions(
        spark,
        {"search_keyword": "Mugs", "action_time": at(4, 1)},
        {"click_category_id": 5, "action_time": at(4, 2)},
    )
    got = session_full_info(df, users(spark, {"professional": None, "city": None, "sex": None}))
    assert rows(got) == [
        ("s", 1, "Mugs", "5", 60, 2, "2021-01-27 4:01:00", 40, None, None, None)
    ]


def test_category_counts_split_id_lists(spark):
    df = actions(
        spark,
        {"click_category_id": 1},
        {"order_category_ids": "1,2"},
        {"order_category_ids": "2, 3"},
        {"pay_category_ids": 3},
        {"click_category_id": None},
    )
    assert rows(category_counts(df)) == [(1, 1, 1, 0), (2, 0, 2, 0), (3, 0, 1, 1)]


def test_top_categories_order_and_scope(spark):
    clicks = [{"session_id": "a", "click_category_id": c} for c in (1, 1, 2, 2, 3)]
    extra = [
        {"session_id": "a", "order_category_ids": "2"},
        {"session_id": "a", "pay_category_ids": 4},
        {"session_id": "z", "click_category_id": 9},
    ]
    df = actions(spark, *clicks, *extra)
    chosen = spark.createDataFrame([("a",)], "session_id string")
    got = top_categories(df, chosen, "t", limit=3)
    assert got.columns == TOP_CATEGORIES.names
    assert [tuple(r) for r in got.collect()] == [
        ("t", 2, 2, 1, 0),
        ("t", 1, 2, 0, 0),
        ("t", 3, 1, 0, 0),
    ]


def test_sample_is_exact_repeatable_and_a_subset(spark):
    df = actions(spark, *[{"session_id": f"s{n}", "search_keyword": "Mugs"} for n in range(30)])
    chosen = sessions.session_summary(df)
    first = rows(pick_sessions(chosen, 10, seed=1).select("session_id"))
    again = rows(pick_sessions(chosen.repartition(3), 10, seed=1).select("session_id"))
    assert len(first) == 10 and first == again
    assert set(first) <= set(rows(chosen.select("session_id")))
    assert pick_sessions(chosen, 100).count() == 30
    sample = sample_sessions(chosen, df, "t", size=10, seed=1)
    assert sample.columns == SAMPLE.names
    assert [r[1] for r in rows(sample)] == [r[0] for r in first]


def test_samples_of_any_size_follow_one_ranking(spark, monkeypatch):
    chosen = spark.range(500).selectExpr("concat('s', id) as session_id", "id as start_time")
    ids = [f"s{n}" for n in range(500)]
    ranked = sorted(ids, key=lambda s: (hashlib.md5(f"3:{s}".encode()).hexdigest(), s))
    for digits in (4, 1):  # with one digit, groups are large and are cut inside
        monkeypatch.setattr(sampling, "GROUP_DIGITS", digits)
        for size in (0, 1, 37, 499, 500, 900):
            got = {r.session_id for r in pick_sessions(chosen, size, seed=3).collect()}
            assert got == set(ranked[:size])


def with_ids(df):
    """Actions of one instant, numbered against their order in the table."""
    return df.withColumn("action_id", 100 - F.monotonically_increasing_id())


def test_ties_are_broken_by_action_id(spark):
    df = with_ids(
        actions(
            spark,
            {"user_id": 1, "click_category_id": 10, "search_keyword": "a"},
            {"user_id": 3, "click_category_id": 9, "search_keyword": "b"},
            {"user_id": 2, "click_category_id": 10, "action_time": at(5)},
        ).coalesce(1)
    )
    assert sessions.session_summary(df).first()["user_id"] == 3
    assert rows(sessions.session_term_lists(df)) == [("s", "b,a", "9,10")]
    # Without action ids: the smallest user, terms in text order.
    bare = df.drop("action_id")
    assert sessions.session_summary(bare).first()["user_id"] == 1
    assert rows(sessions.session_term_lists(bare)) == [("s", "a,b", "10,9")]


def test_order_of_use_is_exact(spark):
    times = [at(4), at(4) + datetime.timedelta(microseconds=1), at(3, 59, 59)]
    rows_ = [(t, n) for t in times for n in (-(2**63), -1, 0, 2**63 - 1)]
    df = spark.createDataFrame(rows_, "t timestamp_ntz, n bigint")
    keyed = df.select("t", "n", use_order(F.col("t"), F.col("n")).alias("key")).collect()
    assert [(r.t, r.n) for r in sorted(keyed, key=lambda r: r.key)] == sorted(rows_)


def test_id_lists_with_empty_and_odd_parts(spark):
    df = actions(spark, *[{"order_category_ids": ids} for ids in ("3,14,", ",", "x,3", "14, 3", "")])
    assert rows(category_counts(df)) == [(14, 0, 2, 0), (3, 0, 3, 0)]


@pytest.mark.parametrize("size", [100, 10**6])
def test_sample_keeps_sessions_without_terms(spark, size):
    df = actions(spark, {"session_id": "plain"}, {"session_id": "x", "search_keyword": "Mugs"})
    sample = sample_sessions(sessions.session_summary(df), df, "t", size=size)
    assert rows(sample) == [
        ("t", "plain", "2021-01-27 4:00:00", "", ""),
        ("t", "x", "2021-01-27 4:00:00", "Mugs", ""),
    ]


def test_top_products(spark):
    df = actions(
        spark,
        *[{"city_id": 1, "click_product_id": p} for p in (1, 1, 2, 3, 100, 100, 100)],
        {"city_id": 2, "click_product_id": 1},
        {"city_id": 3},
    )
    info = [(1, "one", '{"product_status":1'), (2, "two", '{"product_status":0}')]
    copies = [info[0]] * 5
    got = top_products_by_city(df, spark.createDataFrame(info + copies, PRODUCTS))
    assert rows(got) == [
        (1, 1, 100, None, None, 3),
        (1, 2, 1, "one", 1, 2),
        (1, 3, 2, "two", 0, 1),
        (2, 1, 1, "one", 1, 1),
    ]


def test_stored_actions_are_typed(spark):
    schema = "date string, action_time string"
    stored = spark.createDataFrame([("2021-01-27", "2021-01-27 4:34:30")], schema)
    row = typed_actions(stored).first()
    assert (str(row["date"]), row["action_time"]) == ("2021-01-27", at(4, 34, 30))


def test_chunks_join_to_the_lists(spark):
    data = [(f"s{n % 3}", at(3, n % 60), n, f"k{n % 17}", -1) for n in range(90)]
    data += [("crawler", at(4), n, None, n % 500) for n in range(1500)]
    schema = "session_id string, action_time timestamp_ntz, action_id bigint, search_keyword string, "
    schema += "click_category_id bigint"
    df = spark.createDataFrame(data, schema)
    lists = {r.session_id: (r.search_keywords, r.click_categories) for r in sessions.session_term_lists(df).collect()}
    for size, crowded in ((7, 10**9), (7, 30), (10_000, 10**9)):
        chunks = sessions.session_term_chunks(df, size=size, crowded_rows=crowded).collect()
        assert max(r.n_terms for r in chunks) <= size
        joined = {}
        for row in sorted(chunks, key=lambda r: (r.session_id, r.list, r.chunk)):
            assert row.chunk == len(joined.setdefault((row.session_id, row.list), []))
            joined[row.session_id, row.list].append(row.terms)
        for session, (keywords, categories) in lists.items():
            assert ",".join(joined.get((session, "search_keywords"), [""])) == keywords
            assert ",".join(joined.get((session, "click_categories"), [""])) == categories
