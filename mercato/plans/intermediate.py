"""Intermediate models: lazy frames that the marts build on, never written.

Models take the wanted columns. A join or aggregate whose columns nobody wants
is left out, which the optimizer cannot do by itself: it does not know that a
lookup holds one row per key.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.functions import day_diff, from_micros, micros
from mercato.operators.bloom import BloomFilter
from mercato.operators.joins import Lookup, enrich, fits_broadcast, only_keys_of
from mercato.plans import staging
from mercato.sources.bucketed import listing_id
from mercato.sources.raw import Sources

# Payment type -> the summary column holding its amount. Other types count
# towards the total only.
PAYMENT_TYPE_COLUMNS = {
    "credit_card": "credit_card_value",
    "boleto": "boleto_value",
    "voucher": "voucher_value",
    "debit_card": "debit_card_value",
}

PAYMENT_METRICS = [
    "total_payment_value",
    "max_installments",
    "installment_payment_count",
    *PAYMENT_TYPE_COLUMNS.values(),
    "payment_record_count",
]

SLA_METRICS = ["shipping_deadline", "is_seller_sla_breach"]

DELIVERY_METRICS = [
    "delivery_delay_days",
    "is_on_time_delivery",
    "is_seller_sla_breach",
    "seller_processing_days",
]

ORDER_TIMES = ["ordered_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at"]

# Items that meet their listings in one task, at most: about 250 MB are sorted.
_JOINED_ROWS = 500_000

# Names and order of output columns, here and below.
DELIVERY_COLUMNS = [
    "order_id",
    "order_status",
    "ordered_at",
    "shipped_at",
    "delivered_at",
    "estimated_delivery_at",
    "shipping_deadline",
    *DELIVERY_METRICS,
]

ORDERS_JOINED_COLUMNS = [
    "order_id",
    "order_item_id",
    "customer_id",
    "customer_unique_id",
    "order_status",
    *ORDER_TIMES,
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "item_total_value",
    "shipping_limit_at",
    "product_category_name",
    "product_category_name_english",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "seller_city",
    "seller_state",
]


def _of_orders(rows: DataFrame, few_orders: DataFrame | None) -> DataFrame:
    """Keep the rows of `few_orders` if given; the rest then never leaves the scan.

    Many orders would need a shuffle of the raw rows instead, which costs more
    than aggregating all of them map-side first.
    """
    return rows if few_orders is None else only_keys_of(rows, few_orders, "order_id")


def order_payments_summary(
    src: Sources, few_orders: DataFrame | None = None, keys: BloomFilter | None = None
) -> DataFrame:
    """Payments, one row per order. Amounts keep six decimals, and an order up to 9 * 10^11 units.

    With `keys`, orders that this filter rules out are left out.
    """
    payments = staging.payments(src)
    if keys:
        payments = keys.maybe(payments, "order_id")
    paid = micros("payment_value")
    by_type = [
        from_micros(F.sum(F.when(F.col("payment_type") == kind, paid).otherwise(0))).alias(column)
        for kind, column in PAYMENT_TYPE_COLUMNS.items()
    ]
    return (
        _of_orders(payments, few_orders)
        .groupBy("order_id")
        .agg(
            from_micros(F.sum(paid)).alias("total_payment_value"),
            F.max("payment_installments").alias("max_installments"),
            F.sum(F.when(F.col("payment_installments") > 1, 1).otherwise(0)).alias(
                "installment_payment_count"
            ),
            *by_type,
            F.count("*").alias("payment_record_count"),
        )
    )


def shipping_deadlines(src: Sources, few_orders: DataFrame | None = None) -> DataFrame:
    """The earliest seller deadline of each order."""
    return (
        _of_orders(staging.order_items(src), few_orders)
        .groupBy("order_id")
        .agg(F.min("shipping_limit_at").alias("shipping_deadline"))
    )


def with_delivery_metrics(orders: DataFrame, columns: Collection[str]) -> DataFrame:
    """Add the wanted delivery metrics to rows with order times (and `shipping_deadline`)."""
    metrics = {
        "delivery_delay_days": day_diff("estimated_delivery_at", "delivered_at"),
        # An unknown estimate or deadline counts as missed.
        "is_on_time_delivery": F.when(
            F.col("delivered_at").isNotNull(),
            F.coalesce(F.col("delivered_at") <= F.col("estimated_delivery_at"), F.lit(False)),
        ),
        "seller_processing_days": day_diff("ordered_at", "shipped_at"),
    }
    if "is_seller_sla_breach" in columns:
        metrics["is_seller_sla_breach"] = F.when(
            F.col("shipped_at").isNotNull(),
            ~F.coalesce(F.col("shipped_at") <= F.col("shipping_deadline"), F.lit(False)),
        )
    return orders.withColumns({name: c for name, c in metrics.items() if name in columns})


def delivery_performance(
    src: Sources, columns: Collection[str] = tuple(DELIVERY_COLUMNS)
) -> DataFrame:
    """Delay, on-time and seller-deadline flags, one row per order.

    Orders and deadlines both hold one row per order, so their join has no hot
    keys; the items behind a deadline are reduced before the shuffle.
    """
    orders = staging.orders(src)
    if set(SLA_METRICS) & set(columns):
        orders = orders.join(shipping_deadlines(src), "order_id", "left")
    return with_delivery_metrics(orders, columns).select(*columns)


def products_with_category(src: Sources, settings: Settings) -> DataFrame:
    """Products with the English category name, or the original where there is none."""
    joined = enrich(
        staging.products(src),
        [
            Lookup(
                staging.category_translation(src).withColumnRenamed(
                    "product_category_name_english", "translated"
                ),
                "product_category_name",
                size=src.size("category_translation"),
            )
        ],
        settings,
        size=src.size("products"),
    )
    return joined.withColumn(
        "product_category_name_english", F.coalesce("translated", "product_category_name")
    ).drop("translated")


def orders_joined(
    src: Sources, settings: Settings, columns: Collection[str] = tuple(ORDERS_JOINED_COLUMNS)
) -> DataFrame:
    """The wide order-item frame. Every item is kept, also without order, product or seller.

    Order columns are put together at order grain and product columns at product
    grain, so the items are shuffled at most once per lookup. Where the sources know their listings,
    sellers and products too large to broadcast are joined at listing grain and cost one shuffle
    together; items in buckets of the order id meet their order without any.
    """
    want = set(columns)
    lookups = []
    of_seller = [c for c in ("seller_city", "seller_state") if c in want]
    if of_seller:
        sellers = staging.sellers(src).select("seller_id", *of_seller)
        lookups.append(Lookup(sellers, "seller_id", size=src.size("sellers")))
    of_product = [c for c in ORDERS_JOINED_COLUMNS if c.startswith("product_") and c in want - {"product_id"}]
    if of_product:
        products = products_with_category(src, settings).select("product_id", *of_product)
        lookups.append(Lookup(products, "product_id", size=src.size("products")))
    of_order = [
        c for c in ("customer_id", "order_status", *ORDER_TIMES, "customer_unique_id") if c in want
    ]
    if of_order:
        orders = staging.orders(src)
        if "customer_unique_id" in want:
            people = staging.customers(src).select("customer_id", "customer_unique_id")
            by_customer = Lookup(people, "customer_id", size=src.size("customers"))
            if src.listings is not None and not _is_small(by_customer, settings):
                orders = _with_person(orders, by_customer, settings, src)
            else:
                orders = enrich(orders, [by_customer], settings, size=src.size("orders"))
        lookups.append(
            Lookup(orders.select("order_id", *of_order), "order_id", size=src.size("orders"))
        )
    items, ids = staging.order_items(src), {}
    if of_seller and of_product and src.listings is not None and not any(_is_small(x, settings) for x in lookups[:2]):
        # Listings lie in buckets of the product, so they are shuffled to their sellers and to the items only.
        pairs = src.listings.select("product_id", "seller_id")
        of_listing = enrich(pairs, lookups[1::-1], settings, size=src.size("listings")).withColumn("listing", listing_id())
        by_listing = Lookup(
            of_listing.select("listing", *of_seller, *of_product), "listing", size=src.size("listings")
        )
        # Both ids are shuffled within the listing's.
        items = items.withColumn("listing", listing_id()).drop("product_id", "seller_id")
        ids = {c: F.col(f"listing.{c}").alias(c) for c in ("product_id", "seller_id")}
        lookups = [*lookups[2:], by_listing]
        rows = src.size("order_items")()
        tasks = -(-rows // _JOINED_ROWS)
        if tasks > int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            keys, least = [x.on for x in lookups], settings.hot_key_min_rows
            hot = src.hot_keys.get("order_items", items, keys, rows, settings) if rows >= least else {}
            if "listing" not in hot:
                # Too many rows for the session's number of tasks. Hot listings are salted instead.
                items = enrich(
                    items, lookups[:-1], settings, size=src.size("order_items"), known_hot=(src.hot_keys, "order_items")
                )
                of_listing = by_listing.frame.repartition(tasks, "listing")
                items, lookups = items.repartition(tasks, "listing").join(of_listing, "listing", "left"), []
    total = F.col("price") + F.col("freight_value")
    items = enrich(
        items,
        lookups,
        settings,
        size=src.size("order_items"),
        known_hot=(src.hot_keys, "order_items"),
    )
    return items.select(
        *[total.alias(c) if c == "item_total_value" else ids.get(c, c) for c in columns]
    )


def _with_person(orders: DataFrame, by_customer: Lookup, settings: Settings, src: Sources) -> DataFrame:
    """Orders in buckets of their id, with what is known of the customer: just both ids are shuffled to customers and back."""
    # In a certain order, as salts come from row positions.
    pairs = orders.select("order_id", "customer_id").distinct().sortWithinPartitions("order_id", "customer_id")
    known = enrich(pairs, [by_customer], settings, size=src.size("orders"))
    known = known.select(F.col("order_id").alias("__order"), F.col("customer_id").alias("__customer"), "customer_unique_id")
    # Equal customers, said so that Spark keeps to the buckets of the order id.
    same = F.col("customer_id").between(F.col("__customer"), F.col("__customer"))
    return orders.join(known, (F.col("order_id") == F.col("__order")) & same, "left").drop("__order", "__customer")


def _is_small(lookup: Lookup, settings: Settings) -> bool:
    return fits_broadcast(lookup.size, settings.broadcast_max_rows, lookup.frame, settings.broadcast_max_bytes)


def fan_out_report(src: Sources) -> DataFrame:
    """What joining payments to items does to rows and money, with and without the summary.

    `joined_rows` is the row count after joining the per-order summary, which
    must equal the item count; `naive_rows` is what joining the raw tables would
    give. Items are counted per order first, so neither join is made at item grain.
    """
    items = staging.order_items(src).groupBy("order_id").agg(F.count("*").alias("items"))
    per_order = items.join(order_payments_summary(src), "order_id", "left")
    count = F.col("items").cast("decimal(15,0)")
    copies = F.coalesce(F.col("payment_record_count"), F.lit(1)).cast("decimal(15,0)")
    payment = F.col("total_payment_value")
    return per_order.agg(
        F.sum("items").alias("joined_rows"),
        F.sum(count * copies).cast("decimal(38,0)").alias("naive_rows"),
        F.sum(payment).cast("decimal(38,2)").alias("payment_total"),
        F.sum(count * payment).cast("decimal(38,2)").alias("payment_total_over_items"),
    )
