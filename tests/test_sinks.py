from __future__ import annotations

import pathlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_distribution import STEP_COUNTS, VISIT_COUNTS, sessions_with

from clickloom.functions.buckets import STEP, VISIT
from clickloom.operators.distribution import ratio_row, visit_length_ratio
from clickloom.sinks import append_result, append_result_text, replace_table
from clickloom.sources.tables import read_ratio_text


def test_replace(spark):
    replace_table(spark.range(3), "sink_plain")
    replace_table(spark.range(5).selectExpr("id", "id % 2 as part"), "sink_plain", "part")
    assert rows(spark.table("sink_plain").select("id", "part")) == [(n, n % 2) for n in range(5)]


def test_append_by_task(spark):
    sessions = spark.createDataFrame([(100,), (400,)], "visit_length bigint")
    for task in ("t1", "t2", "t1"):  # the first task runs again
        append_result(visit_length_ratio(sessions, task), "sink_ratio")
    got = spark.table("sink_ratio").select("task_id", "session_count", "visit_0_300")
    assert rows(got) == [("t1", 2, 0.5), ("t2", 2, 0.5)]


def test_a_failed_replacement_changes_nothing(spark, tmp_path):
    for part in (None, "part"):
        df = spark.range(6).selectExpr("id", "id % 2 as part")
        name, path = f"sink_atomic_{part}", str(tmp_path / f"{part}")
        replace_table(df, name, part, path)
        failing = df.withColumn("id", F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error("lost").cast("bigint")))
        with pytest.raises(Exception, match="lost"):
            replace_table(failing, name, part, path)
        assert rows(spark.table(name).select("id", "part")) == rows(df)
        assert len(list(pathlib.Path(path).glob("version-*"))) == 1
        replace_table(df.where("id > 3"), name, part, path)
        assert rows(spark.table(name).select("id", "part")) == rows(df.where("id > 3"))
        assert len(list(pathlib.Path(path).glob("version-*"))) == 1


def test_a_table_replaced_by_its_own_rows(spark):
    replace_table(spark.range(5), "sink_own")
    replace_table(spark.table("sink_own").where("id <> 2"), "sink_own")
    assert rows(spark.table("sink_own")) == [(0,), (1,), (3,), (4,)]
    replace_table(spark.range(0), "sink_own", None)
    assert rows(spark.table("sink_own")) == []


def test_append_leaves_the_session_alone(spark):
    mode = "spark.sql.sources.partitionOverwriteMode"
    sessions = spark.createDataFrame([(100,), (400,)], "visit_length bigint")

    def put(task):
        append_result(visit_length_ratio(sessions, task), "sink_many")
        return spark.conf.get(mode)

    put("t0")
    with ThreadPoolExecutor(3) as pool:
        modes = set(pool.map(put, ["t1", "t2", "t3", "t0"]))
    assert modes == {spark.conf.get(mode)} and spark.conf.get(mode).lower() == "static"
    assert sorted(r.task_id for r in spark.table("sink_many").collect()) == ["t0", "t1", "t2", "t3"]


@pytest.mark.parametrize("kind, counts", [(STEP, STEP_COUNTS), (VISIT, VISIT_COUNTS)])
def test_text_layout_of_the_recorded_results(spark, tmp_path, kind, counts):
    path = str(tmp_path / "ratios")
    result = {t: ratio_row(sessions_with(spark, kind, counts), t, kind) for t in ("t1", "t2", "t3")}
    with ThreadPoolExecutor(2) as pool:  # at the same time
        list(pool.map(lambda task: append_result_text(result[task], path), ["t1", "t2"]))
    append_result_text(ratio_row(sessions_with(spark, kind, counts[:3]), "t3", kind), path)
    append_result_text(result["t1"], path)
    for task in ("t1", "t2"):
        line = "\x01".join([task, "480", *[str(n / 480) for n in counts]]) + "\n"
        texts = [f.read_text() for f in pathlib.Path(path, f"task={task}").glob("part-*") if f.stat().st_size]
        assert texts == [line]
    stored = read_ratio_text(spark, path, kind.ratio_columns())
    assert rows(stored.where("task_id <> 't3'")) == rows(result["t1"].unionAll(result["t2"]))
    assert stored.where("task_id = 't3' and session_count = 0").first()[2] is None
