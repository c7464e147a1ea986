"""Business figures over the facts. Each returns a small frame.

`*_COLUMNS` name the fact columns a figure reads, so that callers can build or
read just those. Amounts are summed with six decimals and rounded to cents once, at
the end; payment and delivery columns
repeat on every item of an order and are taken once per order before use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.functions import safe_divide, sum_money
from mercato.plans.intermediate import PAYMENT_TYPE_COLUMNS

GMV_COLUMNS = ["item_total_value"]
AOV_COLUMNS = ["order_id", "item_total_value"]
ON_TIME_COLUMNS = ["order_id", "is_on_time_delivery"]
DELAY_COLUMNS = ["order_id", "delivery_delay_days"]
SLA_COLUMNS = ["is_seller_sla_breach"]
INSTALLMENT_COLUMNS = ["order_id", "installment_payment_count", "payment_record_count"]
AVG_REVIEW_COLUMNS = ["review_score"]
LATE_NEGATIVE_COLUMNS = ["is_negative_review", "is_late_delivery_negative_review"]
REPEAT_COLUMNS = ["customer_key", "order_id"]
CATEGORY_COLUMNS = ["product_key", "price"]
PAYMENT_MIX_COLUMNS = ["order_id", "total_payment_value", *PAYMENT_TYPE_COLUMNS.values()]


def _total(amount: Column) -> Column:
    return F.sum(amount).cast("decimal(38,2)")


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _per_order(orders: DataFrame, *columns: str) -> DataFrame:
    """One row per order. The columns are equal on all its items."""
    return orders.groupBy("order_id").agg(*[F.max(c).alias(c) for c in columns])


def gmv(orders: DataFrame) -> DataFrame:
    return orders.agg(sum_money("item_total_value").cast("decimal(38,2)").alias("gmv"))


def average_order_value(orders: DataFrame) -> DataFrame:
    """Summed per order first, which also makes the order count a plain count."""
    per_order = orders.groupBy("order_id").agg(sum_money("item_total_value").alias("amount"))
    return per_order.agg(
        _total(F.col("amount")).alias("gmv"), F.count("order_id").alias("order_count")
    ).select("gmv", "order_count", safe_divide(F.col("gmv").cast("double"), "order_count").alias("aov"))


def on_time_rate(orders: DataFrame) -> DataFrame:
    """Share of on-time orders among those delivered."""
    return (
        _per_order(orders, "is_on_time_delivery")
        .agg(
            _count_if(F.col("is_on_time_delivery")).alias("on_time_orders"),
            F.count("is_on_time_delivery").alias("delivered_orders"),
        )
        .withColumn("on_time_rate", safe_divide("on_time_orders", "delivered_orders"))
    )


def average_delay(orders: DataFrame) -> DataFrame:
    """Mean delay in days over items and, beside it, over orders."""
    per_order = orders.groupBy("order_id").agg(
        F.max("delivery_delay_days").cast("bigint").alias("delay"),
        F.count("delivery_delay_days").alias("items"),
    )
    return per_order.agg(
        F.sum(F.col("delay") * F.col("items")).alias("item_delay_days"),
        F.sum("items").alias("delivered_items"),
        F.sum("delay").alias("order_delay_days"),
        F.count("delay").alias("delivered_orders"),
    ).select(
        safe_divide("item_delay_days", "delivered_items").alias("avg_delay_days"),
        safe_divide("order_delay_days", "delivered_orders").alias("avg_delay_days_per_order"),
    )


def sla_breach_rate(orders: DataFrame) -> DataFrame:
    """Share of items whose order left after its first seller deadline, among shipped ones."""
    return orders.agg(
        _count_if(F.col("is_seller_sla_breach")).alias("breached_items"),
        F.count("is_seller_sla_breach").alias("shipped_items"),
    ).withColumn("sla_breach_rate", safe_divide("breached_items", "shipped_items"))


def installment_rate(orders: DataFrame) -> DataFrame:
    return (
        _per_order(orders, "installment_payment_count", "payment_record_count")
        .agg(
            F.sum("installment_payment_count").alias("installment_payments"),
            F.sum("payment_record_count").alias("payments"),
        )
        .withColumn("installment_rate", safe_divide("installment_payments", "payments"))
    )


def average_review_score(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        F.count("review_score").alias("scored_reviews"), F.avg("review_score").alias("avg_review_score")
    )


def late_negative_rate(reviews: DataFrame) -> DataFrame:
    """Share of negative reviews whose order was late."""
    return reviews.agg(
        _count_if(F.col("is_late_delivery_negative_review")).alias("late_negative_reviews"),
        _count_if(F.col("is_negative_review")).alias("negative_reviews"),
    ).withColumn("late_negative_rate", safe_divide("late_negative_reviews", "negative_reviews"))


def repeat_customer_rate(orders: DataFrame) -> DataFrame:
    """Share of customers with more than one order.

    Items become orders first (map-side, for the most part), which are then counted. Both
    steps hash; a least or greatest id, being text, would have to be sorted.
    """
    per_customer = (
        orders.filter(F.col("customer_key").isNotNull())
        .select("customer_key", "order_id")
        .distinct()
        .groupBy("customer_key")
        .agg(F.count("order_id").alias("orders"))
    )
    return per_customer.agg(
        _count_if(F.col("orders") > 1).alias("repeat_customers"), F.count("*").alias("customers")
    ).withColumn("repeat_customer_rate", safe_divide("repeat_customers", "customers"))


def top_categories(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The `n` categories with the highest revenue.

    Items are summed per product before they meet the product dimension.
    """
    per_product = orders.groupBy("product_key").agg(sum_money("price").alias("revenue"))
    names = products.select("product_key", "product_category_name_english")
    return (
        per_product.join(names, "product_key", "left")
        .groupBy("product_category_name_english")
        .agg(_total(F.col("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("product_category_name_english"))
        .limit(n)
    )


def payment_mix(orders: DataFrame) -> DataFrame:
    """Paid amount by payment type, each order once."""
    columns = PAYMENT_MIX_COLUMNS[1:]
    return _per_order(orders, *columns).agg(*[_total(F.col(c)).alias(c) for c in columns])


def _in_usd(orders: DataFrame, rates: DataFrame, settings: Settings, how: str) -> DataFrame:
    total = gmv(orders).withColumn("currency_code", F.lit(settings.default_currency))
    # Ten decimals and seven digits before them, whatever the currency.
    rate = F.col("rate_to_usd").cast("decimal(17,10)")
    return rates.join(F.broadcast(total), "currency_code", how).withColumn(
        "gmv_usd", (F.col("gmv").cast("decimal(20,2)") * rate).cast("decimal(38,8)")
    )


def gmv_usd(orders: DataFrame, rates: DataFrame, settings: Settings) -> DataFrame:
    """Merchandise value in US dollars, from the currency the data is kept in."""
    return _in_usd(orders, rates, settings, "inner").select(
        "currency_code", "gmv", "rate_to_usd", "gmv_usd"
    )


def rates_with_gmv(orders: DataFrame, rates: DataFrame, settings: Settings) -> DataFrame:
    """Every exchange rate, with the merchandise value of the currency the data is kept in."""
    return _in_usd(orders, rates, settings, "left").select(
        "currency_code", "currency_name", "rate_to_usd", "effective_date", "gmv", "gmv_usd"
    )
