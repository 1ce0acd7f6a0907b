"""Model tables derived from the star-schema and event tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1_000
) -> DataFrame:
    """The same table as a file stream; a backlog is read in batches of so many files.

    The bracketed last letter makes the path a pattern, so that a table kept as one
    file and a table kept as a folder are both accepted.
    """
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def _session_key(grain: str) -> Column:
    user = F.col("user_id").cast("string")
    by_day = F.concat(user, F.lit("_"), F.to_date("ts").cast("string"))
    if grain == "day":
        return by_day
    if grain == "mixed":
        week = F.floor((F.dayofyear("ts") - 1) / 7).cast("string")
        third = F.col("user_id") % 3
        return (
            F.when(third == 0, by_day)
            .when(third == 1, F.concat(user, F.lit("_w"), week))
            .otherwise(user)
        )
    raise ValueError(f"unknown session grain: {grain}")


def actions(events: DataFrame, grain: str = "day") -> DataFrame:
    """Events as user actions. ``action_id`` orders actions of the same instant.

    ``grain`` sets the session: a user's day, or (``mixed``) day, week or whole history
    depending on the user, which spreads step counts over more buckets.
    """
    kind, k = F.col("event_type"), F.col("k")
    # A pattern reads the one flat number several times faster than a JSON parser.
    number = F.nullif(F.regexp_extract("props", r'"k":\s*(-?\d+)', 1), F.lit(""))
    keyed = events.withColumn("k", number.cast("bigint"))
    return keyed.select(
        F.to_date("ts").alias("date"),
        "user_id",
        _session_key(grain).alias("session_id"),
        (k % 10 + 1).alias("page_id"),
        F.col("ts").alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), k % 10)).alias("search_keyword"),
        F.when(kind == "click", k).otherwise(-1).alias("click_category_id"),
        F.when(kind == "click", k).otherwise(-1).alias("click_product_id"),
        F.when(kind == "signup", k.cast("string")).alias("order_category_ids"),
        F.when(kind == "signup", k.cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", k).alias("pay_category_ids"),
        F.when(kind == "purchase", k).alias("pay_product_ids"),
        (F.col("user_id") % 11).alias("city_id"),
        F.col("event_id").alias("action_id"),
    )


def users(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"),
        F.concat(F.lit("user"), key).alias("username"),
        F.col("c_name").alias("name"),
        (key * 37 % 51 + 10).alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey")).alias("city"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("sex"),
    )


def products(part: DataFrame) -> DataFrame:
    """Every fifth product lacks the closing brace, as stored attributes may."""
    key = F.col("p_partkey")
    return part.select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(
            F.lit('{"product_status":'),
            key % 2,
            F.when(key % 5 == 0, "").otherwise("}"),
        ).alias("extend_info"),
    )
