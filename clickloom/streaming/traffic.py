"""Click traffic over time, on a stream or on a batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.sessions import has_click
from clickloom.sources.shared import fresh_folder, make_folder

PERIOD = "1 day"

# State of open periods lies on local disk, backed up in the checkpoint, and not on the heap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def wall_clock(time: Column) -> Column:
    """Instant whose UTC reading is the wall clock of the session's time zone.

    Windows start at UTC midnight; on this clock they start at local midnight.
    """
    return F.from_utc_timestamp(time.cast("timestamp"), F.current_timezone())


def _clicks(actions: DataFrame) -> DataFrame:
    return actions.where(has_click()).select(
        "action_id", wall_clock(F.col("action_time")).alias("clicked_at")
    )


def _periods(counts: DataFrame, *others: str) -> DataFrame:
    """Period bounds back in the session's time zone."""
    zone = F.current_timezone()
    return counts.select(
        F.to_utc_timestamp("period.start", zone).alias("period_start"),
        F.to_utc_timestamp("period.end", zone).alias("period_end"),
        "clicks",
        *others,
    )


def clicks_per_period(actions: DataFrame, period: str = PERIOD) -> DataFrame:
    """Number of clicks per tumbling period, repeated deliveries of an action counted once.

    The first aggregate drops repeats and combines copies before the shuffle, so an action
    delivered very often loads no single task. Days follow the session's time zone.
    """
    once = _clicks(actions).groupBy(F.window("clicked_at", period).alias("period"), "action_id").agg(
        F.count("*").alias("copies")
    )
    return _periods(once.groupBy("period").agg(F.count("*").alias("clicks")))


def _seen(clicks: DataFrame, period: str) -> DataFrame:
    """Clicks that no earlier batch brought, by period and action."""
    now = F.current_timestamp()  # one instant in all rows of a batch, the same if it is repeated
    return (
        clicks.withColumn("now", now)
        .groupBy(F.window("clicked_at", period).alias("period"), "action_id")
        .agg(F.min("now").alias("first_seen"))
        .where(F.col("first_seen") == now)
        .select(F.lit(True).alias("is_new"), "period", F.lit(None).cast("timestamp").alias("clicked_at"))
    )


def _limit(spark: SparkSession, folder: str, number: int, watermark: str) -> Column:
    """Time up to whose periods the clicks of a batch are late; null if none are.

    State forgets periods by the latest click of all batches before the last one.
    """
    if number < 2:
        return F.lit(None).cast("timestamp")
    latest = spark.read.schema("latest timestamp").parquet(f"{folder}/latest/batch={number - 2}").first()
    return F.lit(latest["latest"] if latest else None).cast("timestamp") - F.expr(f"interval {watermark}")


def _latest(spark: SparkSession, folder: str, number: int, counts: DataFrame) -> None:
    """Keep the time of the latest click of all batches so far, for later batches."""
    times = counts.select("latest")
    if number:
        times = times.unionAll(spark.read.schema("latest timestamp").parquet(f"{folder}/latest/batch={number - 1}"))
    total = times.agg(F.max("latest").alias("latest"))
    total.coalesce(1).write.mode("overwrite").parquet(f"{folder}/latest/batch={number}")


def start_traffic(
    actions: DataFrame,
    folder: str,
    period: str = PERIOD,
    watermark: str | None = None,
    settings: Mapping[str, str] = STREAM_SETTINGS,
    **trigger,
) -> StreamingQuery:
    """Add up clicks of an action stream in ``folder``; ``trigger`` defaults to ``availableNow``.

    An action is new in the batch that first brings it; a batch writes the numbers of its
    new actions by period, into a folder of its own, which a repeated batch replaces.
    ``read_traffic`` adds the batches up, so every period is reported, open ones too.

    Without ``watermark`` nothing is ever late: files of a backlog may come in any order
    and in any number of batches. The state has an entry for each action of the source,
    which a finite source bounds. With it, for a stream without end, the state forgets a
    period once clicks are so much later; deliveries that come for such a period are not
    added, but counted by period as ``late_deliveries``. Settings hold for the started
    query only.
    """
    clicks = _clicks(actions)
    if watermark is None:
        rows = _seen(clicks, period)
    else:
        read = clicks.select(
            F.lit(False).alias("is_new"), F.window("clicked_at", period).alias("period"), "clicked_at"
        )
        rows = _seen(clicks.withWatermark("clicked_at", watermark), period).unionAll(read)

    def add_up(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        late = F.lit(False)
        if watermark is not None:
            late = ~F.col("is_new") & (F.col("period.end") <= _limit(session, folder, number, watermark))
        counts = batch.groupBy("period").agg(
            F.count_if("is_new").alias("clicks"),
            F.count_if(late).alias("late_deliveries"),
            F.max("clicked_at").alias("latest"),
        )
        path = f"{folder}/counts/batch={number}"
        _periods(counts, "late_deliveries", "latest").write.mode("overwrite").parquet(path)
        if watermark is not None:
            _latest(session, folder, number, session.read.parquet(path))

    session = actions.sparkSession
    make_folder(session, f"{folder}/counts")  # a source without data writes no batch
    before = {name: session.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            session.conf.set(name, value)
        return (
            rows.writeStream.outputMode("update")
            .foreachBatch(add_up)
            .option("checkpointLocation", f"{folder}/state")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        for name, value in before.items():
            session.conf.unset(name) if value is None else session.conf.set(name, value)


def read_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks and late deliveries per period so far."""
    schema = "period_start timestamp, period_end timestamp, clicks bigint, late_deliveries bigint, batch bigint"
    batches = spark.read.schema(schema).parquet(f"{folder}/counts")
    totals = batches.groupBy("period_start", "period_end").agg(
        F.sum("clicks").alias("clicks"), F.sum("late_deliveries").alias("late_deliveries")
    )
    return totals.where("clicks > 0 or late_deliveries > 0")


def run_traffic(actions: DataFrame, period: str = PERIOD) -> DataFrame:
    """Clicks of all that the source holds now, however many batches it takes."""
    folder = fresh_folder(actions.sparkSession, "traffic")
    start_traffic(actions, folder, period).awaitTermination()
    return read_traffic(actions.sparkSession, folder).drop("late_deliveries")
