"""Staging: one projection per raw table. No filter, no deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.sources.raw import Sources


def _time(raw: str, name: str):
    return F.col(raw).cast("timestamp_ntz").alias(name)


def customers(src: Sources) -> DataFrame:
    return src.customers.select(
        "customer_id",
        "customer_unique_id",
        F.upper("customer_city").alias("customer_city"),
        "customer_state",
        "customer_zip_code_prefix",
    )


def orders(src: Sources) -> DataFrame:
    return src.orders.select(
        "order_id",
        "customer_id",
        "order_status",
        _time("order_purchase_timestamp", "ordered_at"),
        _time("order_approved_at", "approved_at"),
        _time("order_delivered_carrier_date", "shipped_at"),
        _time("order_delivered_customer_date", "delivered_at"),
        _time("order_estimated_delivery_date", "estimated_delivery_at"),
    )


def order_items(src: Sources) -> DataFrame:
    return src.order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _time("shipping_limit_date", "shipping_limit_at"),
        "price",
        "freight_value",
    )


def products(src: Sources) -> DataFrame:
    return src.products.select(
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def payments(src: Sources) -> DataFrame:
    return src.payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def sellers(src: Sources) -> DataFrame:
    return src.sellers.select(
        "seller_id",
        F.upper("seller_city").alias("seller_city"),
        "seller_state",
        "seller_zip_code_prefix",
    )


def reviews(src: Sources) -> DataFrame:
    return src.reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        _time("review_creation_date", "review_created_at"),
        _time("review_answer_timestamp", "review_answered_at"),
    )


def geolocation(src: Sources) -> DataFrame:
    return src.geolocation.select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        F.upper("geolocation_city").alias("geolocation_city"),
        "geolocation_state",
    )


def category_translation(src: Sources) -> DataFrame:
    return src.category_translation.select("product_category_name", "product_category_name_english")


MODELS = {
    "stg_customers": customers,
    "stg_orders": orders,
    "stg_order_items": order_items,
    "stg_products": products,
    "stg_payments": payments,
    "stg_sellers": sellers,
    "stg_reviews": reviews,
    "stg_geolocation": geolocation,
    "stg_category_translation": category_translation,
}


def create_views(src: Sources) -> list[str]:
    """Register every staging model as a temporary view; returns the view names."""
    for name, model in MODELS.items():
        model(src).createOrReplaceTempView(name)
    return list(MODELS)
