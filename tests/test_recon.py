from __future__ import annotations

import datetime
from dataclasses import replace

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators.ordering import with_ranges
from clickloom.operators.recon import duplicate_keys, reconcile
from clickloom.plans.reconciliation import reconcile_datasets
from clickloom.sinks import read_audit, write_report

C = datetime.datetime(2018, 1, 1, 1, 1, 1)
ABC = "a bigint, b bigint, c timestamp"


def pair(spark, one, two, schema=ABC, schema2=None):
    return spark.createDataFrame(one, schema), spark.createDataFrame(two, schema2 or schema)


def mismatches(result) -> dict:
    return dict(rows(result.mismatch))


def test_recorded_pair(spark):
    one, two = pair(spark, [(1, 2, C), (3, 4, C)], [(1, 3, C), (5, 6, C)])
    result = reconcile(one, two, "a")
    assert rows(result.audit) == [
        ("a", 0, 1, 1, 0, 0),
        ("b", 1, 1, 1, 0, 0),
        ("c", 0, 1, 1, 0, 0),
    ]
    assert rows(result.missing_keys) == [("source1", 5), ("source2", 3)]
    text = "2018-01-01 01:01:01"
    assert result.field_to_field.columns == [
        f"{name}_{side}" for name in "abc" for side in ("source1", "source2")
    ]
    assert rows(result.field_to_field) == [
        (1, 1, 2, 3, text, text),
        (3, None, 4, None, text, None),
        (None, 5, None, 6, None, text),
    ]


def test_equal_sources(spark):
    one, two = pair(spark, [(1, 2), (3, 4)], [(1, 2), (3, 4)], "a bigint, b bigint")
    result = reconcile(one, two, "a")
    assert rows(result.audit) == [("a", 0, 0, 0, 0, 0), ("b", 0, 0, 0, 0, 0)]
    assert rows(result.missing_keys) == []


def test_null_and_value(spark):
    one, two = pair(spark, [(1, None), (2, None)], [(1, None), (2, 5)], "a bigint, b bigint")
    assert mismatches(reconcile(one, two, "a")) == {"a": 0, "b": 1}


def test_nan(spark):
    nan = float("nan")
    one, two = pair(spark, [(1, nan), (2, 1.0)], [(1, nan), (2, nan)], "a bigint, b double")
    assert mismatches(reconcile(one, two, "a"))["b"] == 1
    assert mismatches(reconcile(one, two, "a", nan_differs=True))["b"] == 2


def test_null_keys_pair_up_but_never_mismatch(spark):
    one, two = pair(spark, [(None, 1)], [(None, 2)], "a bigint, b bigint")
    result = reconcile(one, two, "a")
    assert mismatches(result) == {"a": 0, "b": 0}
    assert rows(result.missing_keys) == []
    assert rows(result.field_to_field) == [(None, None, 1, 2)]
    lone = reconcile(one, two.where("a is not null"), "a")
    assert rows(lone.missing_keys) == [("source2", None)]


def test_duplicate_keys(spark):
    one, two = pair(spark, [(1, 5), (1, 4), (2, 2)], [(1, 4), (2, 3)], "a bigint, b bigint")
    result = reconcile(one, two, "a")
    assert rows(result.audit) == [("a", 0, 0, 0, 1, 0), ("b", 1, 0, 0, 1, 0)]
    assert rows(result.duplicate_keys) == [(1, 2, 1)]
    assert rows(result.field_to_field) == [(1, 1, 4, 4), (1, None, 5, None), (2, 2, 2, 3)]
    assert rows(duplicate_keys(one, "a")) == [(1, 2)]


def test_positions_decide(spark):
    one, two = pair(spark, [(1, 2)], [(1, 2)], "a bigint, b bigint", "x bigint, y int")
    result = reconcile(one, two, "A")
    assert mismatches(result) == {"a": 0, "b": 0}
    assert result.missing_keys.columns == ["missing_from", "a"]


def test_repeated_column_names(spark):
    one = spark.sql("select 1 as a, 2 as b, 3 as b")
    two = spark.sql("select 1 as a, 2 as b, 4 as b")
    assert rows(reconcile(one, two, "a").mismatch) == [("a", 0), ("b", 0), ("b", 1)]


def test_map_and_nested_columns(spark):
    schema = "a bigint, m map<string,int>, s struct<x:int,y:array<int>>"
    one, two = pair(
        spark,
        [(1, {"p": 1, "q": 2}, (1, [1])), (2, {"p": 1}, (1, [1]))],
        [(1, {"q": 2, "p": 1}, (1, [1])), (2, {"p": 2}, (1, [2]))],
        schema,
    )
    assert mismatches(reconcile(one, two, "a")) == {"a": 0, "m": 1, "s": 1}


def test_sources_that_do_not_fit(spark):
    base = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    with pytest.raises(ValueError, match="width"):
        reconcile(base, base.select("a"), "a")
    with pytest.raises(TypeError, match="cannot compare b"):
        reconcile(base, base.selectExpr("a", "cast(b as string) b"), "a")
    with pytest.raises(ValueError, match="not a column"):
        reconcile(base, base, "z")
    with pytest.raises(ValueError, match="different positions"):
        reconcile(base, base.select("b", "a"), "a")


def test_maps_inside_are_refused(spark):
    one = spark.sql("select 1 as a, struct(map('p', 1)) as s")
    with pytest.raises(TypeError, match="map inside"):
        reconcile(one, one, "a")


def test_plans(spark):
    one, two = pair(spark, [(1, 2)], [(1, 3)], "a bigint, b bigint")
    result = reconcile(one, two, "a")
    for df in (result.field_to_field, result.mismatch, result.audit, result.missing_keys):
        assert "SortAggregate" not in plan(df)
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    # Missing keys need one shuffle of the keys alone.
    text = plan(result.missing_keys)
    assert text.count("Exchange") == 1 and "Join" not in text


def test_values_that_hash_alike_differ(spark):
    schema = "a bigint, b bigint, c bigint, d array<int>, e array<string>, f struct<x:int,y:int>"
    same = (1, [1], ["x"], (1, 1))
    one, two = pair(
        spark,
        [(1, None, *same), (2, 5, 1, [None, 1], ["x"], (1, 1)), (3, 5, 1, [1], [None], (1, 1)),
         (4, 5, 1, [1], ["x"], (None, 1)), (5, None, None, None, None, None)],
        [(1, 1, None, *same[1:]), (2, 5, 1, [1, None], ["x"], (1, 1)), (3, 5, 1, [1], ["null"], (1, 1)),
         (4, 5, 1, [1], ["x"], (1, None)), (5, None, None, None, None, None)],
        schema,
    )
    assert mismatches(reconcile(one, two, "a")) == {"a": 0, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1}


def test_keys_and_values_of_different_widths(spark):
    one = spark.createDataFrame([(1, 2, 0.0), (3, 4, 1.0)], "a int, b int, c double")
    two = spark.createDataFrame([(1, 2, -0.0), (3, 5, 1.0), (5, 6, 1.0)], "a bigint, b bigint, c float")
    for x, y, lacking in ((one, two, (1, 0)), (two, one, (0, 1))):
        found = rows(reconcile(x, y, "a").audit)
        assert [r[1] for r in found] == [0, 1, 0] and found[0][2:4] == lacking


def test_equal_rows_are_not_joined(spark, tmp_path):
    df = spark.range(2000).selectExpr("id as a", "id % 7 as b", "cast(id as string) as c")
    df.write.parquet(str(tmp_path / "one"))
    df.selectExpr("a", "if(a = 77, -1, b) as b", "c").write.parquet(str(tmp_path / "two"))
    one, two = (spark.read.parquet(str(tmp_path / name)) for name in ("one", "two"))
    for other, differing in ((one, 0), (two, 1)):
        audit = reconcile(one, other, "a").audit
        assert rows(audit) == [("a", 0, 0, 0, 0, 0), ("b", differing, 0, 0, 0, 0), ("c", 0, 0, 0, 0, 0)]
        final = plan(audit).split("Initial Plan")[0]
        # Counts and digests of both, then, if a key differs, the rows of both.
        assert final.count("Scan parquet") <= (4 if differing else 2)
    metrics = reconcile(one, two, "a")
    buckets = metrics.counts.where("not (d1 <=> d2 and e1 <=> e2)").count()
    assert buckets == 1


def test_large_repeated_keys_are_spread(spark):
    n = 3000
    one = spark.range(n).selectExpr("if(id % 3 < 2, 0, id) as a", "md5(string(id)) as b")
    two = spark.range(n).selectExpr("if(id % 3 < 2, 0, id) as a", "md5(string(id * 2)) as b")
    result = replace(reconcile(one, two, "a"), crowded_rows=100)
    fields = [tuple(r) for r in result.field_to_field.collect()]
    assert len(fields) == n
    for place, df in ((0, one), (1, two)):
        assert sorted(f[place::2] for f in fields) == sorted(map(tuple, df.collect()))
    hot = sorted((f[2], f[3]) for f in fields if f[0] == 0)
    assert hot == list(zip(sorted(h[0] for h in hot), sorted(h[1] for h in hot)))
    cut = with_ranges(result.rows1, ["key"], ["row1"], 100)
    sizes = cut.groupBy("key", "_range").count().agg(F.max("count")).first()[0]
    assert sizes <= 200


def test_configured_datasets_and_report(spark, tmp_path):
    spark.range(10).selectExpr("id as user_id", "id % 3 as v").createOrReplaceTempView("recon_users")
    config = {
        "datasets": {
            "dataset1": {
                "source1_sql": "select * from recon_users order by user_id limit 6",
                "source2_sql": "select * from recon_users order by user_id limit 8",
                "identifier": "user_id",
            },
            "dataset2": {
                "source1_sql": "select user_id, v from recon_users",
                "source2_sql": "select user_id, 0 as v from recon_users",
                "identifier": "user_id",
            },
        }
    }
    results = reconcile_datasets(spark, config)
    assert rows(results["dataset1"].missing_keys) == [("source1", 6), ("source1", 7)]
    write_report(results, str(tmp_path))
    audit = read_audit(spark, str(tmp_path))
    assert rows(audit.select("dataset", "column_name", "mismatch", "missing_from_src1")) == [
        ("dataset1", "user_id", 0, 2),
        ("dataset1", "v", 0, 2),
        ("dataset2", "user_id", 0, 0),
        ("dataset2", "v", 6, 0),
    ]
    fields = spark.read.parquet(f"{tmp_path}/field_to_field/dataset=dataset2")
    assert fields.count() == 10
    assert spark.read.parquet(f"{tmp_path}/missing_keys/dataset=dataset1").count() == 2
    # A later report takes the place of the earlier one as a whole.
    write_report({"dataset2": results["dataset2"]}, str(tmp_path))
    assert {r.dataset for r in read_audit(spark, str(tmp_path)).collect()} == {"dataset2"}


keyed = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 2))),
    max_size=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(one=keyed, two=keyed)
def test_against_brute_force(spark, one, two):
    schema = "a bigint, b bigint"
    got = reconcile(*pair(spark, one, two, schema), "a")
    back = reconcile(*pair(spark, two, one, schema), "a")
    keys = set(k for k, _ in one + two)
    side = lambda data, k: [v for key, v in data if key == k]
    singles = [k for k in keys if k is not None and len(side(one, k)) == len(side(two, k)) == 1]
    expected = (
        sum(side(one, k) != side(two, k) for k in singles),
        sum(not side(one, k) for k in keys),
        sum(not side(two, k) for k in keys),
        sum(len(side(one, k)) > 1 for k in keys),
        sum(len(side(two, k)) > 1 for k in keys),
    )
    assert rows(got.audit)[1][1:] == expected
    # Every row of either side is in the field table exactly once.
    fields = [tuple(r) for r in got.field_to_field.collect()]
    for place, data in ((0, one), (1, two)):
        halves = sorted((f[place::2] for f in fields), key=repr)
        empty = len(fields) - len(data)
        assert halves == sorted([*data, *[(None, None)] * empty], key=repr)
    assert rows(back.audit)[1][2:4] == (expected[2], expected[1])
    assert rows(reconcile(*pair(spark, one, one, schema), "a").audit)[1][1:4] == (0, 0, 0)
