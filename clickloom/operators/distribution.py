"""Distribution of sessions over visit-length and step-length buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.buckets import STEP, VISIT, Buckets
from clickloom.functions.text import encode_counts

_LENGTHS = {VISIT: "visit_length", STEP: "step_length"}


def histogram(
    sessions: DataFrame, buckets: Buckets, *, compat_zero_bucket: bool = False
) -> DataFrame:
    """Number of sessions per bucket that has any."""
    label = buckets.label(F.col(_LENGTHS[buckets]), compat_zero_bucket)
    return sessions.groupBy(label.alias("bucket")).agg(F.count("*").alias("sessions"))


def session_totals(sessions: DataFrame) -> DataFrame:
    """The two totals kept beside the bucket counts; both count the sessions."""
    return sessions.agg(F.count("*").alias("sum_visit")).select(
        "sum_visit", F.col("sum_visit").alias("sum_step")
    )


def session_counters(sessions: DataFrame, *, compat_zero_bucket: bool = False) -> DataFrame:
    """Totals and both histograms as (counter, sessions) rows, in one pass.

    The inner aggregate has at most one row per pair of buckets.
    """
    pairs = sessions.groupBy(
        VISIT.label(F.col("visit_length"), compat_zero_bucket).alias("visit"),
        STEP.label(F.col("step_length"), compat_zero_bucket).alias("step"),
    ).count()
    names = F.array(F.lit("sum_visit"), F.lit("sum_step"), F.col("visit"), F.col("step"))
    counters = pairs.select(F.explode(names).alias("counter"), "count")
    return counters.groupBy("counter").agg(F.sum("count").alias("sessions"))


def observe_counters(
    sessions: DataFrame, *, compat_zero_bucket: bool = False
) -> tuple[DataFrame, Observation]:
    """The same sessions, and an observation of all their counters.

    Whatever action runs on the sessions fills the observation on the way, so counting
    costs no pass of its own. Work that is repeated in the last stage counts once; so use
    the sessions as they are, a shuffle behind them could repeat the stage that counts.
    """
    observation = Observation()
    tests = {}
    for buckets, length in _LENGTHS.items():
        tests |= buckets.tests(F.col(length), compat_zero_bucket)
    totals = [F.count("*").alias(name) for name in ("sum_visit", "sum_step")]
    return sessions.observe(observation, *totals, *[F.count_if(t).alias(n) for n, t in tests.items()]), observation


def observed_counters(spark: SparkSession, observation: Observation) -> DataFrame:
    """(counter, sessions) as ``session_counters`` gives them; waits for the first action."""
    found = [(name, count) for name, count in observation.get.items() if count]
    return spark.createDataFrame(found, "counter string, sessions bigint")


def counters_json(counters: DataFrame) -> DataFrame:
    """All counters as one JSON text with sorted names; there are at most 70."""
    entries = F.collect_list(F.struct("counter", "sessions"))
    return counters.agg(encode_counts(F.map_from_entries(entries)).alias("counters"))


def ratio_row(
    sessions: DataFrame, task_id: str, buckets: Buckets, *, compat_zero_bucket: bool = False
) -> DataFrame:
    """One row: task, session count and each bucket's share of all sessions.

    Sessions beyond the last ratio column still count in the denominator.
    """
    length = F.col(_LENGTHS[buckets])
    counts = sessions.agg(
        F.count("*").alias("session_count"),
        *[
            F.count_if(buckets.contains(length, lo, hi, compat_zero_bucket)).alias(name)
            for (lo, hi), name in zip(buckets.ratio_bounds(), buckets.ratio_columns())
        ],
    )
    return counts.select(
        F.lit(task_id).alias("task_id"),
        "session_count",
        *[F.try_divide(c, "session_count").alias(c) for c in buckets.ratio_columns()],
    )


def visit_length_ratio(sessions: DataFrame, task_id: str, **options: bool) -> DataFrame:
    return ratio_row(sessions, task_id, VISIT, **options)


def step_length_ratio(sessions: DataFrame, task_id: str, **options: bool) -> DataFrame:
    return ratio_row(sessions, task_id, STEP, **options)
