"""The checks declared for the models."""

from __future__ import annotations

from mercato.operators.quality import Check

# The accepted codes.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "invoiced",
    "processing",
    "unavailable",
    "approved",
    "created",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)


def _key(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, kind) for c in columns for kind in ("unique", "not_null")]


CHECKS: list[Check] = [
    *_key("stg_orders", "order_id"),
    Check("stg_orders", "order_status", "accepted_values", values=ORDER_STATUSES),
    *_key("stg_customers", "customer_id"),
    *_key("stg_products", "product_id"),
    *_key("stg_sellers", "seller_id"),
    Check("stg_order_items", "order_id", "not_null"),
    Check("stg_order_items", "order_id", "relationships", to="stg_orders", field="order_id"),
    Check("stg_payments", "order_id", "not_null"),
    Check("stg_payments", "order_id", "relationships", to="stg_orders", field="order_id"),
    Check("stg_payments", "payment_type", "accepted_values", values=PAYMENT_TYPES),
    Check("stg_reviews", "review_score", "accepted_values", values=REVIEW_SCORES),
    *_key("stg_category_translation", "product_category_name"),
    *_key("order_payments_summary", "order_id"),
    Check("order_payments_summary", "total_payment_value", "not_null"),
    *_key("delivery_performance", "order_id"),
    Check("orders_joined", "order_item_id", "not_null"),
    Check("orders_joined", "item_total_value", "not_null"),
    *_key("dim_customers", "customer_key", "customer_unique_id"),
    *_key("dim_sellers", "seller_key", "seller_id"),
    *_key("dim_products", "product_key"),
    *_key("dim_date", "date_key", "date_day"),
    *_key("fct_orders", "order_item_key"),
    Check("fct_orders", "customer_key", "not_null"),
    Check("fct_orders", "customer_key", "relationships", to="dim_customers", field="customer_key"),
    Check("fct_orders", "item_total_value", "not_null"),
    Check("fct_orders", "ordered_at", "no_future_dates"),
    Check("fct_orders", "price", "positive_values"),
    Check("fct_orders", "freight_value", "positive_values"),
    *_key("fct_reviews", "review_key"),
    Check("fct_reviews", "review_score", "not_null"),
    Check("fct_reviews", "review_score", "accepted_values", values=REVIEW_SCORES),
    Check("fct_reviews", "review_score", "valid_scores"),
]
