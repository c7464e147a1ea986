"""Column names and types of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[t]) for name, t in columns.items()])


# The raw column names, including two misspelled ones.
CUSTOMERS = _schema(
    customer_id="string",
    customer_unique_id="string",
    customer_city="string",
    customer_state="string",
    customer_zip_code_prefix="string",
)

ORDERS = _schema(
    order_id="string",
    customer_id="string",
    order_status="string",
    order_purchase_timestamp="timestamp_ntz",
    order_approved_at="timestamp_ntz",
    order_delivered_carrier_date="timestamp_ntz",
    order_delivered_customer_date="timestamp_ntz",
    order_estimated_delivery_date="timestamp_ntz",
    _loaded_at="timestamp_ntz",
)

ORDER_ITEMS = _schema(
    order_id="string",
    order_item_id="bigint",
    product_id="string",
    seller_id="string",
    shipping_limit_date="timestamp_ntz",
    price="double",
    freight_value="double",
)

PRODUCTS = _schema(
    product_id="string",
    product_category_name="string",
    product_name_lenght="bigint",
    product_description_lenght="bigint",
    product_photos_qty="bigint",
    product_weight_g="bigint",
    product_length_cm="bigint",
    product_height_cm="bigint",
    product_width_cm="bigint",
)

PAYMENTS = _schema(
    order_id="string",
    payment_sequential="bigint",
    payment_type="string",
    payment_installments="bigint",
    payment_value="double",
)

SELLERS = _schema(
    seller_id="string",
    seller_city="string",
    seller_state="string",
    seller_zip_code_prefix="string",
)

REVIEWS = _schema(
    review_id="string",
    order_id="string",
    review_score="int",
    review_comment_title="string",
    review_comment_message="string",
    review_creation_date="timestamp_ntz",
    review_answer_timestamp="timestamp_ntz",
)

GEOLOCATION = _schema(
    geolocation_zip_code_prefix="string",
    geolocation_lat="double",
    geolocation_lng="double",
    geolocation_city="string",
    geolocation_state="string",
)

CATEGORY_TRANSLATION = _schema(
    product_category_name="string",
    product_category_name_english="string",
)

EXCHANGE_RATES = _schema(
    currency_code="string",
    currency_name="string",
    rate_to_usd="double",
    effective_date="date",
)

RUN_LOG = _schema(
    model_name="string",
    run_started_at="timestamp",
    run_finished_at="timestamp",
    rows_affected="bigint",
    run_by="string",
)

RAW_TABLES = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "payments": PAYMENTS,
    "sellers": SELLERS,
    "reviews": REVIEWS,
    "geolocation": GEOLOCATION,
    "category_translation": CATEGORY_TRANSLATION,
}
