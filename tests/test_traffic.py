from __future__ import annotations

import datetime
import os
import pathlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.sources.shared import fresh_folder
from clickloom.streaming.traffic import clicks_per_period, read_traffic, run_traffic, start_traffic
from helpers import rows

SCHEMA = "action_id bigint, action_time timestamp_ntz, click_category_id bigint"


def when(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def day_counts(df):
    return [(row[0].day, row[2]) for row in rows(df)]


def batch_of(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_copies_count_once_and_other_actions_not_at_all(spark):
    df = batch_of(
        spark,
        *[(1, when(1, 3), 5)] * 50,
        (2, when(1, 4), 5),
        (3, when(1, 5), -1),
        (4, when(1, 6), None),
        (5, when(2), 7),
    )
    assert day_counts(clicks_per_period(df)) == [(1, 2), (2, 1)]


def test_stream_reports_every_period(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(1, when(1, 3), 5), (1, when(1, 3), 5), (2, when(2, 2), 5), (3, when(3), -1)]
    batch_of(spark, *data).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    assert day_counts(run_traffic(stream)) == [(1, 1), (2, 1)]
    assert rows(run_traffic(stream)) == rows(clicks_per_period(batch_of(spark, *data)))


def test_stream_without_data(spark, tmp_path):
    source = str(tmp_path / "in")
    batch_of(spark).write.parquet(source)
    assert rows(run_traffic(spark.readStream.schema(SCHEMA).parquet(source))) == []
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "none"))
    assert rows(run_traffic(stream)) == []


def test_days_follow_the_session_zone(spark, tmp_path):
    source = str(tmp_path / "in")
    batch_of(spark, (1, when(1, 1), 5), (2, when(1, 23), 5), (3, when(2), 5)).write.parquet(source)
    before = spark.conf.get("spark.sql.session.timeZone")
    text = F.date_format("period_start", "yyyy-MM-dd HH:mm").alias("day")
    try:
        for zone in ("Asia/Shanghai", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            stream = spark.readStream.schema(SCHEMA).parquet(source)
            for counts in (clicks_per_period(spark.read.parquet(source)), run_traffic(stream)):
                found = rows(counts.select(text, "clicks"))
                assert found == [("2024-01-01 00:00", 2), ("2024-01-02 00:00", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stream_goes_on_from_its_state(spark, tmp_path):
    source, folder = str(tmp_path / "in"), fresh_folder(spark, "test")
    batch_of(spark).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)

    def run(*data):
        batch_of(spark, *data).write.mode("append").parquet(source)
        start_traffic(stream, folder, watermark="1 hour").awaitTermination()
        return [(row[0].day, *row[2:]) for row in rows(read_traffic(spark, folder))]

    assert run((1, when(1, 3), 5), (2, when(1, 4), 5)) == [(1, 2, 0)]
    # A repeat of action 1 and a late but not too late new click, then day 2 goes on.
    assert run((1, when(1, 3), 5), (3, when(1, 4), 5), (4, when(2, 12), 5)) == [(1, 3, 0), (2, 1, 0)]
    # Too late for day 1, which closed when the watermark passed its end; a repeat, too.
    late = (5, when(1, 5), 5), (5, when(1, 5), 5), (1, when(1, 3), 5)
    assert run(*late, (6, when(3, 2), 5)) == [(1, 3, 3), (2, 1, 0), (3, 1, 0)]
    # A day of which only late clicks are known.
    assert (31, 0, 1) in run((7, when(31, 5).replace(year=2023, month=12), 5))


def in_files(spark, path, batches):
    """A file for each batch, read in the order given."""
    for n, batch in enumerate(batches):
        batch_of(spark, *batch).coalesce(1).write.mode("append").parquet(path)
        for file in sorted(pathlib.Path(path).glob("part-*"), key=os.path.getmtime)[-1:]:
            os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(SCHEMA)


def backlog(seed, size=12):
    """Files with days in any order, repeats within and across files."""
    rng = random.Random(seed)
    data = [(n, when(rng.randint(1, 28), rng.randint(0, 23)), rng.choice([5, 5, -1, None])) for n in range(300)]
    data += rng.choices(data, k=200)
    rng.shuffle(data)
    return [data[n::size] for n in range(size)]


@pytest.mark.parametrize("files", [1, 3, 1000])
def test_a_backlog_is_never_late(spark, tmp_path, files):
    batches, source = backlog(3), str(tmp_path / "in")
    reader = in_files(spark, source, batches).option("maxFilesPerTrigger", files)
    want = rows(clicks_per_period(batch_of(spark, *[row for batch in batches for row in batch])))
    assert rows(run_traffic(reader.parquet(source))) == want


def plain_stream(batches, delay=1):
    """Clicks and late deliveries by day, batch after batch, as the stream promises."""
    seen, counts, late, latest = set(), Counter(), Counter(), []
    for batch in batches:
        known = [t for t in latest[:-1] if t]
        limit = max(known) - datetime.timedelta(hours=delay) if known else datetime.datetime.min
        clicks = [(action, time) for action, time, category in batch if category not in (-1, None)]
        for action, time in clicks:
            day = time.replace(hour=0)
            if day + datetime.timedelta(days=1) <= limit:
                late[day] += 1
            elif (day, action) not in seen:
                seen.add((day, action))
                counts[day] += 1
        latest.append(max([t for _, t in clicks], default=None))
    return sorted((d.day, counts[d], late[d]) for d in {*counts, *late})


@pytest.mark.parametrize("seed", [4, 5])
def test_late_deliveries_are_counted(spark, tmp_path, seed):
    batches, source, folder = backlog(seed, 6), str(tmp_path / "in"), fresh_folder(spark, "test")
    stream = in_files(spark, source, batches).option("maxFilesPerTrigger", 1).parquet(source)
    start_traffic(stream, folder, watermark="1 hour").awaitTermination()
    found = sorted((row[0].day, *row[2:]) for row in rows(read_traffic(spark, folder)))
    assert found == plain_stream(batches)
    assert sum(row[2] for row in found) > 0


def test_state_is_kept_by_rocksdb(spark, tmp_path):
    source, folder = str(tmp_path / "in"), fresh_folder(spark, "test")
    batch_of(spark, (1, when(1, 3), 5)).write.parquet(source)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    query = start_traffic(spark.readStream.schema(SCHEMA).parquet(source), folder)
    query.awaitTermination()
    assert spark.conf.get(name, None) == before
    assert list((pathlib.Path(folder.removeprefix("file:")) / "state").rglob("*.zip"))
