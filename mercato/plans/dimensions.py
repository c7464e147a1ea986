"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.functions import surrogate_key
from mercato.operators.calendar import day_spine
from mercato.plans import intermediate, staging
from mercato.sources.raw import Sources


def dim_customers(src: Sources) -> DataFrame:
    """One row per person: the one with the greatest customer_id, a NULL id before all.

    Spark keeps the first row per person on the map side already (the rank limit
    is pushed below the shuffle), so a person with very many rows is no problem.
    """
    newest = Window.partitionBy("customer_unique_id").orderBy(F.col("customer_id").desc_nulls_first())
    return (
        staging.customers(src)
        .withColumn("rank", F.row_number().over(newest))
        .filter("rank = 1")
        .select(
            surrogate_key("customer_unique_id").alias("customer_key"),
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "customer_zip_code_prefix",
        )
    )


def dim_sellers(src: Sources) -> DataFrame:
    return staging.sellers(src).select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        "seller_city",
        "seller_state",
        "seller_zip_code_prefix",
    )


def dim_products(src: Sources, settings: Settings) -> DataFrame:
    return intermediate.products_with_category(src, settings).select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        # bigint from the raw schema on, so the product of three lengths fits
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias(
            "product_volume_cm3"
        ),
    )


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    """The calendar. Weeks are ISO weeks beside calendar years; day 0 is Sunday."""
    day = F.col("date_day")
    day_of_week = F.dayofweek(day) - 1
    return day_spine(spark, settings.calendar_start, settings.calendar_days).select(
        surrogate_key("date_day").alias("date_key"),
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.weekofyear(day).alias("week_of_year"),
        day_of_week.alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name_short"),
        day_of_week.isin(0, 6).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat(
            F.lit("Q"), F.quarter(day).cast("string"), F.lit("-"), F.year(day).cast("string")
        ).alias("quarter_label"),
        F.date_format(day, "dd/MM/yyyy").alias("date_formatted"),
    )


def calendar_usage(src: Sources, settings: Settings) -> DataFrame:
    """The calendar with the number of orders placed on each day, days without orders included."""
    per_day = (
        staging.orders(src)
        .groupBy(F.to_date("ordered_at").alias("date_day"))
        .agg(F.count("*").alias("orders_placed"))
    )
    calendar = dim_date(src.orders.sparkSession, settings)
    return calendar.join(per_day, "date_day", "left").withColumn(
        "orders_placed", F.coalesce("orders_placed", F.lit(0))
    )
