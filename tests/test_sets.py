from __future__ import annotations

from helpers import plan, rows

from clickloom.operators.sets import except_distinct, intersect_distinct, union_all


def sides(spark):
    one = spark.createDataFrame([(1, 2), (3, 4), (3, 4), (None, 1)], "a bigint, b bigint")
    two = spark.createDataFrame([(1, 2), (5, 6), (5, 6), (None, 1)], "a bigint, b bigint")
    return one, two


def test_small_intersection(spark):
    one = spark.createDataFrame([(1, 2), (3, 4)], "a bigint, b bigint")
    two = spark.createDataFrame([(1, 2), (5, 6)], "a bigint, b bigint")
    assert rows(intersect_distinct(one, two)) == [(1, 2)]


def test_same_as_the_built_in_operators(spark):
    one, two = sides(spark)
    assert rows(intersect_distinct(one, two)) == rows(one.intersect(two))
    assert rows(except_distinct(one, two)) == rows(one.subtract(two)) == [(3, 4)]
    assert rows(except_distinct(two, one)) == rows(two.subtract(one)) == [(5, 6)]


def test_any_column_names(spark):
    one, two = sides(spark)
    for names in (["a.b", "in_left"], ["x", "x"], ["c1", "c0"]):
        left, right = one.toDF(*names), two.toDF(*names)
        assert rows(intersect_distinct(left, right)) == rows(one.intersect(two))
        assert except_distinct(left, right).columns == names


def test_union_keeps_copies(spark):
    one, two = sides(spark)
    assert union_all(one, two).count() == 8


def test_one_shuffle(spark):
    one, two = sides(spark)
    assert plan(except_distinct(one, two)).count("Exchange") == 1
    assert plan(intersect_distinct(one, two)).count("Exchange") == 1
