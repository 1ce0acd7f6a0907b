from __future__ import annotations

import json
import pathlib
import subprocess
import sys
import textwrap

import pytest
from helpers import rows

from clickloom.functions.buckets import STEP, VISIT
from clickloom.operators import distribution
from clickloom.sources.tables import read_ratio_text

# Sessions per bucket of two recorded results, 480 sessions each.
STEP_COUNTS = [0, 0, 0, 8, 35, 30, 28, 26, 33, 30, 38, 23, 26, 31, 25, 22, 25, 23, 42, 35]
VISIT_COUNTS = [0, 0, 0, 0, 0, 0, 0, 0, 1, 6, 47, 426]


def sessions_with(spark, kind, counts):
    """Sessions whose lengths fill the buckets by the given counts, at their upper edges."""
    lengths = [hi for (_, hi), n in zip(kind.ratio_bounds(), counts) for _ in range(n)]
    name = "visit_length" if kind is VISIT else "step_length"
    return spark.createDataFrame([(n,) for n in lengths], f"{name} bigint")


@pytest.mark.parametrize("kind, counts", [(STEP, STEP_COUNTS), (VISIT, VISIT_COUNTS)])
def test_recorded_ratios(spark, kind, counts):
    row = distribution.ratio_row(sessions_with(spark, kind, counts), "t", kind).first()
    assert list(row)[:2] == ["t", 480]
    assert list(row)[2:] == [n / 480 for n in counts]


def test_recorded_ratio_text(spark, tmp_path):
    counts = STEP_COUNTS
    line = "\x01".join(["task", "480", *[str(n / 480) for n in counts]])
    (tmp_path / "part-0").write_text(line + "\n")
    stored = read_ratio_text(spark, str(tmp_path), STEP.ratio_columns())
    fresh = distribution.step_length_ratio(sessions_with(spark, STEP, counts), "task")
    assert stored.columns == fresh.columns
    assert rows(stored) == rows(fresh)


def test_sessions_out_of_range_stay_in_the_denominator(spark):
    df = spark.createDataFrame([(0,), (300,), (3601,), (90_000,)], "visit_length bigint")
    row = distribution.visit_length_ratio(df, "t").first()
    assert (row["session_count"], row["visit_0_300"]) == (4, 0.5)
    compat = distribution.visit_length_ratio(df, "t", compat_zero_bucket=True).first()
    assert compat["visit_0_300"] == 0.25


def test_no_sessions(spark):
    df = spark.createDataFrame([], "visit_length bigint, step_length bigint")
    row = distribution.step_length_ratio(df, "t").first()
    assert row["session_count"] == 0 and row["step_0_5"] is None
    assert rows(distribution.session_totals(df)) == [(0, 0)]
    assert rows(distribution.histogram(df, VISIT)) == []


def test_counters_agree_with_histograms(spark):
    df = spark.createDataFrame(
        [(0, 1), (10, 6), (301, 6), (8000, 500)], "visit_length bigint, step_length bigint"
    )
    counters = dict(rows(distribution.session_counters(df)))
    assert counters.pop("sum_visit") == counters.pop("sum_step") == 4
    both = rows(distribution.histogram(df, VISIT)) + rows(distribution.histogram(df, STEP))
    assert counters == dict(both)
    assert sum(n for _, n in rows(distribution.histogram(df, VISIT))) == 4
    text = distribution.counters_json(distribution.session_counters(df)).first()[0]
    parsed = json.loads(text)
    assert list(parsed) == sorted(parsed)
    assert parsed == {**counters, "sum_visit": 4, "sum_step": 4}


@pytest.mark.parametrize("compat", [False, True])
def test_counters_are_observed_on_the_way(spark, compat):
    data = [(0, 1), (10, 6), (301, 6), (7200, 200), (7201, 201), (8000, 500)]
    df = spark.createDataFrame(data, "visit_length bigint, step_length bigint")
    for rows_in in (df, df.limit(0)):
        seen, observation = distribution.observe_counters(rows_in, compat_zero_bucket=compat)
        assert rows(seen) == rows(rows_in)
        counters = distribution.session_counters(rows_in, compat_zero_bucket=compat)
        assert rows(distribution.observed_counters(spark, observation)) == rows(counters)


def test_repeated_tasks_are_counted_once(tmp_path):
    """Every task of the last stage fails at first, after it has passed its rows."""
    script = f"""
        import sys
        sys.path.insert(0, {str(pathlib.Path(distribution.__file__).parents[2])!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from clickloom.operators import distribution

        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        df = spark.range(100, numPartitions=4).selectExpr("id as visit_length", "id as step_length")
        seen, observation = distribution.observe_counters(df)

        def fail_at_first(batches):
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

        seen.mapInArrow(fail_at_first, seen.schema).write.format("noop").mode("overwrite").save()
        found = dict(map(tuple, distribution.observed_counters(spark, observation).collect()))
        assert found == dict(map(tuple, distribution.session_counters(df).collect())), found
        print("counted", found["sum_visit"])
    """
    path = tmp_path / "script.py"
    path.write_text(textwrap.dedent(script))
    done = subprocess.run([sys.executable, str(path)], capture_output=True, text=True, timeout=120)
    assert "counted 100" in done.stdout, done.stderr[-2000:]
