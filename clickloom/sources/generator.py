"""Synthetic actions, users and products, generated in parallel from a column of ids.

Each function takes a DataFrame with one integer column ``slot`` (``spark.range(100)``
renamed, or ids of an existing table) and makes rows for every slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.draws import choice, digest, uniform_int

# Search keywords, action kinds, sexes.
SEARCH_KEYWORDS = (
    "Huawei Cell Phone",
    "Lenovo Laptops",
    "Lobsters",
    "Napkins",
    "Vacuum",
    "Lamer",
    "Machine Learning",
    "Apple",
    "Facial Lotions",
    "Mugs",
)
ACTION_KINDS = ("search", "click", "order", "pay")
SEXES = ("Male", "Female")

# Number ranges, closed.
STEPS = (20, 100)
PAGES = (1, 100)
CATEGORIES = (0, 100)
PRODUCTS = (0, 100)
CITIES = (0, 10)
AGES = (10, 60)
PROFESSIONS = (0, 100)
HOME_CITIES = (1, 100)
DEFAULT_USERS = 100
SESSIONS_PER_USER = 10


def slots(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(count).withColumnRenamed("id", "slot")


def _spread(df: DataFrame, column: str) -> DataFrame:
    """Even out a small input before each of its rows becomes many.

    The explicit number keeps adaptive execution from merging the partitions again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)


def generate_actions(
    slots: DataFrame,
    *,
    n_users: int | Column = DEFAULT_USERS,
    sessions_per_slot: int = SESSIONS_PER_USER,
    seed: int = 0,
    date: str | None = None,
) -> DataFrame:
    """Actions in the stored layout: text date and time, unpadded hour, -1 for no click.

    Each slot draws one user (1..n_users) and has ``sessions_per_slot`` sessions; each
    session has 20..100 actions within one hour of the day.
    """
    day = F.lit(date) if date else F.current_date().cast("string")
    sessions = (
        slots.select("slot")
        .withColumn("user_draw", digest(seed, "user", F.col("slot")))
        .withColumn("visit", F.explode(F.sequence(F.lit(1), F.lit(sessions_per_slot))))
        .withColumn("session_id", digest(seed, "session", F.col("slot"), F.col("visit")))
        .withColumn("draw", digest(seed, "shape", F.col("slot"), F.col("visit")))
        .select(
            uniform_int(F.col("user_draw"), 0, 1, n_users).alias("user_id"),
            "session_id",
            uniform_int(F.col("draw"), 0, 0, 23).alias("hour"),
            uniform_int(F.col("draw"), 1, *STEPS).alias("steps"),
        )
    )
    steps = _spread(sessions, "session_id").withColumn(
        "step", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("steps")))
    ).withColumns(
        {
            "when": digest(seed, "when", F.col("session_id"), F.col("step")),
            "what": digest(seed, "what", F.col("session_id"), F.col("step")),
        }
    )
    when, what = F.col("when"), F.col("what")
    kind = choice(what, 0, ACTION_KINDS)
    drawn = steps.select(
        "user_id",
        "session_id",
        "hour",
        uniform_int(when, 0, *PAGES).alias("page_id"),
        uniform_int(when, 1, 0, 59).alias("minute"),
        uniform_int(when, 2, 0, 59).alias("second"),
        uniform_int(when, 3, *CITIES).alias("city_id"),
        kind.alias("kind"),
        choice(what, 1, SEARCH_KEYWORDS).alias("keyword"),
        uniform_int(what, 2, *CATEGORIES).alias("category"),
        uniform_int(what, 3, *PRODUCTS).alias("product"),
    )

    def only(action: str, value: Column) -> Column:
        return F.when(F.col("kind") == action, value)

    clock = F.format_string("%s %d:%02d:%02d", day, F.col("hour"), F.col("minute"), F.col("second"))
    category, product = F.col("category"), F.col("product")
    return drawn.select(
        day.alias("date"),
        "user_id",
        "session_id",
        "page_id",
        clock.alias("action_time"),
        only("search", F.col("keyword")).alias("search_keyword"),
        only("click", category).otherwise(-1).alias("click_category_id"),
        only("click", product).otherwise(-1).alias("click_product_id"),
        only("order", category.cast("string")).alias("order_category_ids"),
        only("order", product.cast("string")).alias("order_product_ids"),
        only("pay", category).alias("pay_category_ids"),
        only("pay", product).alias("pay_product_ids"),
        "city_id",
    )


def generate_users(slots: DataFrame, *, seed: int = 0) -> DataFrame:
    """One user per slot, with the slot as id."""
    draw = F.col("draw")
    return slots.withColumn("draw", digest(seed, "person", F.col("slot"))).select(
        F.col("slot").alias("user_id"),
        F.concat(F.lit("user"), "slot").alias("username"),
        F.concat(F.lit("name"), "slot").alias("name"),
        uniform_int(draw, 0, *AGES).alias("age"),
        F.concat(F.lit("professional"), uniform_int(draw, 1, *PROFESSIONS)).alias("professional"),
        F.concat(F.lit("city"), uniform_int(draw, 2, *HOME_CITIES)).alias("city"),
        choice(draw, 3, SEXES).alias("sex"),
    )


def generate_products(slots: DataFrame, *, seed: int = 0) -> DataFrame:
    """One product per slot, with its status as well-formed JSON text."""
    status = uniform_int(digest(seed, "product", F.col("slot")), 0, 0, 1)
    return slots.select(
        F.col("slot").alias("product_id"),
        F.concat(F.lit("product"), "slot").alias("product_name"),
        F.to_json(F.struct(status.alias("product_status"))).alias("extend_info"),
    )
