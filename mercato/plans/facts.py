"""Fact tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from functools import cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.functions import ntz, surrogate_key
from mercato.operators.bloom import bloom_filter, size_for
from mercato.operators.joins import Lookup, enrich, fits_broadcast, id_exceptions, only_keys_of
from mercato.plans import dimensions, intermediate, staging
from mercato.plans.intermediate import DELIVERY_METRICS, ORDER_TIMES, PAYMENT_METRICS, SLA_METRICS
from mercato.sources.raw import Sources

FCT_ORDERS_KEY = "order_item_key"

# An update filters items and payments by its orders if these are at most this share of all, and a
# load of the whole fact if they are at most this share of those that items name.
_FILTERED_SHARE = 0.75

# Columns in which items of an order differ, as they are shuffled to their place in the table.
_OF_ITEM = ("order_item_id", "product_id", "seller_id", "price", "freight_value")

# Names and order of output columns, here and below.
FCT_ORDERS_COLUMNS = [
    "order_item_key",
    "order_id",
    "order_item_id",
    "customer_key",
    "seller_key",
    "product_key",
    "order_date_key",
    "order_status",
    *ORDER_TIMES,
    "price",
    "freight_value",
    "item_total_value",
    *PAYMENT_METRICS,
    *DELIVERY_METRICS,
]

FCT_REVIEWS_COLUMNS = [
    "review_key",
    "review_id",
    "order_id",
    "review_date_key",
    "review_score",
    "is_negative_review",
    "delivery_delay_days",
    "is_on_time_delivery",
    "is_late_delivery_negative_review",
    "review_created_at",
    "review_answered_at",
]


def _date_keys(src: Sources, settings: Settings, time: str, key: str) -> DataFrame:
    """(day of `time`, key). The calendar has a fixed, small number of rows."""
    calendar = dimensions.dim_date(src.orders.sparkSession, settings)
    return F.broadcast(calendar.select(F.col("date_day").alias(f"{time}_day"), F.col("date_key").alias(key)))


def _with_date_key(rows: DataFrame, src: Sources, settings: Settings, time: str, key: str) -> DataFrame:
    day = f"{time}_day"
    return (
        rows.withColumn(day, F.to_date(time))
        .join(_date_keys(src, settings, time, key), day, "left")
        .drop(day)
    )


def fct_orders(
    src: Sources,
    settings: Settings,
    since: dt.datetime | None = None,
    columns: Collection[str] = tuple(FCT_ORDERS_COLUMNS),
    arrange: Callable[[DataFrame], DataFrame] | None = None,
    arrange_large: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Order items with keys, money, payment and delivery metrics.

    Loads orders placed from `since` on, or from the configured start date.
    Items without such an order are left out, although every lookup is a left
    join: the time filter is not true for them.

    Everything known per order is joined at order grain, which is several times
    smaller, and reaches the items in one join. The customer key is computed
    from the order's customer, as the customer dimension holds every person the
    customer table names. Delivery metrics come straight from the order row.
    These steps rely on one row per order_id, customer_id, product_id and
    seller_id, which the quality suite checks.

    `arrange` may shuffle the rows and add columns, which are kept. It gets them while they
    are narrow, before keys are hashed and delivery metrics are derived. `arrange_large` takes its place, if given,
    where more than `gather_max_orders` orders are loaded and their items were shuffled to them, evenly.

    Sellers and products too large to broadcast are not joined if the ids that they lack or
    repeat are few: then these are broadcast instead. An update drops the items and payments of other orders in the
    scan, by the ids of its orders or, if these are many but no more than three quarters, by a Bloom filter of them. So does
    a full build that is arranged, if items name orders that aren't there in such numbers.

    Where items are shuffled to their orders anyway and no order is hot, the order's deadline is
    taken from the same exchange, so that items are read and shuffled once. Otherwise deadlines are
    reduced map-side in a scan of their own and joined at order grain.

    Parts that feed none of `columns` are left out of the plan.
    """
    want = set(columns)
    unknown = want - set(FCT_ORDERS_COLUMNS)
    if unknown:
        raise ValueError(f"fct_orders has no columns {sorted(unknown)}")

    placed = staging.orders(src).filter(F.col("ordered_at") >= ntz(since or settings.start_date))
    # A full build needs (nearly) all rows of the tables, an incremental one few.
    placed_size = cache(placed.count) if since else src.size("orders")
    few_orders = None
    if since and fits_broadcast(
        placed_size, settings.broadcast_max_ids, placed.select("order_id"), settings.broadcast_max_bytes
    ):
        few_orders = placed

    keys = None
    if (since or arrange is not None) and few_orders is None and not _broadcasts(placed, placed_size, settings):
        named = src.size("orders") if since else lambda: _orders_named(src)
        if placed_size() <= _FILTERED_SHARE * named():
            sizes = size_for(placed_size(), settings.upsert_filter_bits)
            keys = bloom_filter(placed, "order_id", *sizes) if sizes else None
    orders = placed
    if "customer_key" in want:
        people = staging.customers(src).select("customer_id", "customer_unique_id")
        people_size = src.size("customers")
        if few_orders is not None:
            people, people_size = only_keys_of(people, few_orders, "customer_id"), placed_size
        by_customer = Lookup(people, "customer_id", size=people_size)
        orders = enrich(orders, [by_customer], settings, size=placed_size)
    if want & set(PAYMENT_METRICS):
        orders = orders.join(
            intermediate.order_payments_summary(src, few_orders, keys), "order_id", "left"
        )
    items_size = src.size("order_items")
    sla_of_items = bool(want & set(SLA_METRICS)) and _one_exchange(src, orders, want, placed_size, settings)
    if want & set(SLA_METRICS) and not sla_of_items:
        orders = orders.join(intermediate.shipping_deadlines(src, few_orders), "order_id", "left")
    of_order = want - set(SLA_METRICS) if sla_of_items else want
    metrics_of = set() if arrange is not None else of_order
    orders = intermediate.with_delivery_metrics(orders, metrics_of)

    needed = of_order | {"order_id"} | ({"ordered_at"} if "order_date_key" in want else set())
    if arrange is not None and want & set(DELIVERY_METRICS):
        needed |= {*ORDER_TIMES, "shipping_deadline"}
    needed |= {"customer_unique_id"} if "customer_key" in want else set()
    needed |= {"shipped_at"} if sla_of_items else set()
    orders = orders.select(*[c for c in orders.columns if c in needed])

    items, known_hot = staging.order_items(src), (src.hot_keys, "order_items")
    asked_ids = items
    if not _broadcasts(orders, placed_size, settings):
        if few_orders is not None:
            asked_ids = items = only_keys_of(items, few_orders, "order_id")
            known_hot = None
        elif keys:
            items, known_hot = keys.maybe(items, "order_id"), None

    by_order = Lookup(orders, "order_id", how="inner", size=placed_size)
    lookups, exceptions = [], {}
    for name, ids in (("seller", staging.sellers(src)), ("product", staging.products(src))):
        if f"{name}_key" in want:
            known = ids.select(f"{name}_id", F.lit(True).alias(f"{name}_known"))
            lookup = Lookup(known, f"{name}_id", size=src.size(f"{name}s"), only_ids=True)
            if not fits_broadcast(lookup.size, settings.broadcast_max_ids, known, settings.broadcast_max_bytes):
                flag = f"__{name}_flag"
                found = id_exceptions(asked_ids, ids.select(f"{name}_id"), f"{name}_id", flag, settings)
                if found is not None:
                    exceptions[name] = found
                    by_ids = settings.broadcast_max_ids > settings.broadcast_max_rows
                    lookup = Lookup(found, f"{name}_id", size=lambda: 0, only_ids=by_ids)
            lookups.append(lookup)

    if sla_of_items:
        items = enrich(items, lookups, settings, size=items_size, known_hot=known_hot)
        items = items.withColumn(
            "shipping_deadline", F.min("shipping_limit_at").over(Window.partitionBy("order_id"))
        ).drop("shipping_limit_at")
        items = _of_known_ids(items, lookups, exceptions).join(orders, "order_id")
        if arrange is None:
            items = intermediate.with_delivery_metrics(items, want & set(SLA_METRICS))
    else:
        # A full build shuffles narrow item rows by seller and product before they
        # get their order columns; an incremental one cuts the items down first.
        ordered = [by_order, *lookups] if since else [*lookups, by_order]
        items = enrich(items, ordered, settings, size=items_size, known_hot=known_hot)
        items = _of_known_ids(items, lookups, exceptions)
    added = []
    if arrange is not None:
        # What the items of an order share lies together, as rows that differ in one place only compress best.
        shared = [c for c in items.columns if c not in _OF_ITEM]
        narrow = items.select(*shared, *[c for c in items.columns if c in _OF_ITEM])
        is_large = sla_of_items and placed_size() > settings.gather_max_orders
        items = (arrange_large if is_large and arrange_large is not None else arrange)(narrow)
        added = [c for c in items.columns if c not in narrow.columns]
        items = intermediate.with_delivery_metrics(items, want)
    if "order_date_key" in want:
        items = _with_date_key(items, src, settings, "ordered_at", "order_date_key")
    # Keys are hashed last, so that their 32 characters are not shuffled.
    derived = {
        "order_item_key": surrogate_key("order_id", "order_item_id"),
        "customer_key": F.when(F.col("customer_unique_id").isNotNull(), surrogate_key("customer_unique_id")),
        "seller_key": F.when(F.col("seller_id").isNotNull(), surrogate_key("seller_id")),
        "product_key": F.when(F.col("product_id").isNotNull(), surrogate_key("product_id")),
        "item_total_value": F.col("price") + F.col("freight_value"),
    }
    return items.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in columns], *added)


def _of_known_ids(items: DataFrame, lookups: Collection[Lookup], exceptions: Collection[str]) -> DataFrame:
    """`items` with NULL for the seller and product ids that are not known, instead of flags beside them."""
    for column in [x.on for x in lookups]:
        name = column.removesuffix("_id")
        flag = f"__{name}_flag" if name in exceptions else f"{name}_known"
        # An id without an exception is known; one that a join hasn't found is not.
        is_known = F.coalesce(flag, F.lit(True)) if name in exceptions else F.col(flag)
        items = items.withColumn(column, F.when(is_known, F.col(column))).drop(flag)
    return items


def _orders_named(src: Sources) -> int:
    """About how many orders the items name. No row is shuffled for it."""
    return staging.order_items(src).agg(F.approx_count_distinct("order_id", 0.02)).first()[0]


def _broadcasts(orders: DataFrame, size: Callable[[], int], settings: Settings) -> bool:
    return fits_broadcast(size, settings.broadcast_max_rows, orders, settings.broadcast_max_bytes)


def _one_exchange(
    src: Sources, orders: DataFrame, want: set[str], placed_size: Callable[[], int], settings: Settings
) -> bool:
    """Whether the exchange that brings all items to their orders can give the deadlines too."""
    kept = [c for c in orders.columns if c in want | {"order_id", "shipped_at"}]
    if _broadcasts(orders.select(*kept), placed_size, settings):
        return False
    rows = src.size("order_items")()
    if rows < settings.hot_key_min_rows:
        return True
    asked = ["seller_id", "product_id", "order_id"]  # together, as the joins ask for them too
    return "order_id" not in src.hot_keys.get("order_items", staging.order_items(src), asked, rows, settings)


def fct_reviews(
    src: Sources, settings: Settings, columns: Collection[str] = tuple(FCT_REVIEWS_COLUMNS)
) -> DataFrame:
    """Reviews with the delivery outcome of their order. Always all reviews."""
    want = set(columns)
    reviews = staging.reviews(src)
    if want & {"delivery_delay_days", "is_on_time_delivery", "is_late_delivery_negative_review"}:
        delivery = intermediate.delivery_performance(
            src, ["order_id", "delivery_delay_days", "is_on_time_delivery"]
        )
        by_order = Lookup(delivery, "order_id", size=src.size("orders"))
        reviews = enrich(reviews, [by_order], settings, size=src.size("reviews"))
    if "review_date_key" in want:
        reviews = _with_date_key(reviews, src, settings, "review_created_at", "review_date_key")

    negative = F.coalesce(F.col("review_score") <= 2, F.lit(False))
    derived = {
        "review_key": lambda: surrogate_key("review_id", "order_id"),
        "is_negative_review": lambda: negative,
        "is_late_delivery_negative_review": lambda: negative
        & F.coalesce(~F.col("is_on_time_delivery"), F.lit(False)),
    }
    return reviews.select(*[derived[c]().alias(c) if c in derived else F.col(c) for c in columns])
