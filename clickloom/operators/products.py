"""Most clicked products per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.text import product_status


def top_products_by_city(actions: DataFrame, products: DataFrame, limit: int = 3) -> DataFrame:
    """The ``limit`` products with most clicks in each city, with name and status.

    Clicks are counted per city and product first. Spark keeps only the first ``limit``
    rows of a city in each task before the shuffle on the city.
    """
    clicks = (
        actions.where("click_product_id <> -1")
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count("*").alias("clicks"))
    )
    ranking = Window.partitionBy("city_id").orderBy(F.desc("clicks"), "product_id")
    top = clicks.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= limit)
    # Only products that are named; copies of a row tell nothing new and would pile up.
    named = products.join(top.select("product_id").distinct(), "product_id", "left_semi")
    details = named.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    ).distinct()
    return top.join(details, "product_id", "left").select(
        "city_id", "rank", "product_id", "product_name", "product_status", "clicks"
    )
