from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.functions import buckets, draws, text, times
from clickloom.session_filter import SessionFilter, parse_list


def values(spark, data, schema, column):
    return [row[0] for row in spark.createDataFrame(data, schema).select(column).collect()]


def test_unpadded_time(spark):
    data = [("2021-01-27 4:34:30", "2021-01-27 04:35:06")]
    a, b = F.col("a"), F.col("b")
    assert values(spark, data, "a string, b string", times.time_earlier(a, b)) == [True]
    assert values(spark, data, "a string, b string", times.time_earlier(a, a)) == [False]
    elapsed = times.elapsed_seconds(times.parse_action_time(a), times.parse_action_time(b))
    assert values(spark, data, "a string, b string", elapsed) == [36]
    again = times.format_action_time(times.parse_action_time(b))
    assert values(spark, data, "a string, b string", again) == ["2021-01-27 4:35:06"]
    parts = values(spark, data, "a string, b string", times.time_parts(a))
    assert parts == [["2021", "01", "27", "4", "34", "30"]]


def test_elapsed_over_a_day(spark):
    data = [("2021-01-27 4:00:00", "2021-01-28 5:00:00")]
    a, b = times.parse_action_time(F.col("a")), times.parse_action_time(F.col("b"))
    schema = "a string, b string"
    assert values(spark, data, schema, times.elapsed_seconds(a, b)) == [90_000]
    assert values(spark, data, schema, times.elapsed_seconds(a, b, wrap_day=True)) == [3_600]


def test_elapsed_does_not_depend_on_the_session_time_zone(spark):
    data = [("2021-03-28 0:30:00", "2021-03-28 4:30:00")]
    a, b = times.parse_action_time(F.col("a")), times.parse_action_time(F.col("b"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert values(spark, data, "a string, b string", times.elapsed_seconds(a, b)) == [14_400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_pad_two(spark):
    data = [("4",), ("04",), ("",), ("123",)]
    got = values(spark, data, "s string", text.pad_two(F.col("s")))
    assert got == ["04", "04", "", "123"]


@pytest.mark.parametrize(
    "kind, length, label",
    [
        (buckets.VISIT, 0, "visit_0_300"),
        (buckets.VISIT, 1, "visit_0_300"),
        (buckets.VISIT, 300, "visit_0_300"),
        (buckets.VISIT, 301, "visit_300_600"),
        (buckets.VISIT, 3600, "visit_3300_3600"),
        (buckets.VISIT, 7200, "visit_6900_7200"),
        (buckets.VISIT, 7201, "visit_length > 7200"),
        (buckets.STEP, 1, "step_0_5"),
        (buckets.STEP, 5, "step_0_5"),
        (buckets.STEP, 6, "step_5_10"),
        (buckets.STEP, 20, "step_15_20"),
        (buckets.STEP, 200, "step_195_200"),
        (buckets.STEP, 201, "step_length > 200"),
    ],
)
def test_bucket_edges(spark, kind, length, label):
    assert values(spark, [(length,)], "n bigint", kind.label(F.col("n"))) == [label]


def test_zero_bucket_compatibility(spark):
    label = buckets.VISIT.label(F.col("n"), compat_zero_bucket=True)
    assert values(spark, [(0,), (1,)], "n bigint", label) == ["visit_7200_0", "visit_0_300"]


def test_ratio_columns():
    assert buckets.VISIT.ratio_columns()[0] == "visit_0_300"
    assert buckets.VISIT.ratio_columns()[-1] == "visit_3300_3600"
    assert len(buckets.VISIT.ratio_columns()) == 12
    assert buckets.STEP.ratio_columns()[-1] == "step_95_100"
    assert len(buckets.STEP.ratio_columns()) == 20


def test_packed_summary(spark):
    packed = "session_id=s1|search_keywords=Apple,Mugs|visit_length=36|age=30"
    column = F.array(*[text.packed_field(F.col("p"), n) for n in ("session_id", "age", "sex")])
    assert values(spark, [(packed,)], "p string", column) == [["s1", "30", None]]


def test_id_lists(spark):
    assert values(spark, [("3,14",)], "s string", text.split_ids(F.col("s"))) == [["3", "14"]]
    assert values(spark, [(7,)], "n bigint", text.split_ids(F.col("n"))) == [["7"]]


def test_product_status(spark):
    data = [('{"product_status":1',), ('{"product_status":0}',), ("{}",), (None,)]
    status = text.product_status(F.col("s"))
    assert values(spark, data, "s string", status) == [1, 0, None, None]


def test_count_maps(spark):
    counts = text.decode_counts(F.col("s"))
    data = [('{"b": 2, "a": 1}',)]
    assert values(spark, data, "s string", counts) == [{"a": 1, "b": 2}]
    assert values(spark, data, "s string", text.encode_counts(counts)) == ['{"a":1,"b":2}']


def test_draws_cover_the_closed_range(spark):
    source = draws.digest(3, "test", F.col("id"))
    drawn = spark.range(4000).select(
        draws.uniform_int(source, 0, 20, 29).alias("n"),
        draws.choice(source, 1, ("x", "y")).alias("c"),
        F.length(source).alias("len"),
    )
    row = drawn.agg(
        F.min("n"), F.max("n"), F.count_distinct("n"), F.count_distinct("c"), F.max("len")
    ).first()
    assert tuple(row) == (20, 29, 10, 2, 32)
    with pytest.raises(ValueError):
        draws.uniform_int(source, 4, 0, 1)


def test_filter_parameters():
    assert parse_list("1, 2,3") == ("1", "2", "3")
    assert parse_list("") == parse_list(None) == ()
    params = SessionFilter.from_params({"start_age": 20, "target_page_flow": "4, 5"})
    assert (params.start_age, params.end_age, params.page_flow) == (20, 50, [4, 5])
    with pytest.raises(TypeError):
        SessionFilter.from_params({"no_such": 1})
