"""Runs that write: the whole warehouse, the incremental order fact, the seller history."""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.operators import audit
from mercato.operators.quality import run_checks
from mercato.operators.snapshot import history_table, snapshot
from mercato.operators.upsert import require_unique, upsert
from mercato.plans import dimensions, facts, intermediate, staging
from mercato.plans.checks import CHECKS
from mercato.sources.published import PublishedTable, Version
from mercato.sources.raw import Sources, conform
from mercato.sources.schemas import ORDERS
from mercato.sources.seeds import exchange_rates

log = logging.getLogger(__name__)

ORDER_PARTITION = "order_period"
_PERIOD = {"month": "%Y-%m", "day": "%Y-%m-%d"}
_SPARK_PERIOD = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}

# Columns of a seller whose change opens a new version in the seller history.
SELLER_CHECK_COLUMNS = ("seller_city", "seller_state")


_CHECKED_LAZILY = ("delivery_performance", "orders_joined")


class Warehouse:
    """The written tables under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def table(self, name: str, partition_column: str | None = None) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.path}/marts/{name}", partition_column)

    @property
    def fct_orders(self) -> PublishedTable:
        return self.table("fct_orders", ORDER_PARTITION)

    @property
    def seller_history(self) -> PublishedTable:
        return history_table(self.spark, f"{self.path}/snapshots/sellers")

    @property
    def seed(self) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.path}/seeds/exchange_rates")

    @property
    def run_log_path(self) -> str:
        return f"{self.path}/audit/model_run_log"

    def run_log(self, with_run_id: bool = False) -> DataFrame:
        return audit.read_log(self.spark, self.run_log_path, with_run_id)


def partition_by_period(orders: DataFrame, settings: Settings) -> DataFrame:
    """Add the partition column, whose values sort by time. It is not a column of the model."""
    period = F.date_format("ordered_at", _SPARK_PERIOD[settings.fact_partition])
    return orders.select(period.alias(ORDER_PARTITION), "*")


def watermark(version: Version, settings: Settings) -> dt.datetime | None:
    """Start of the late-arrival window. Only the newest partition is read for it."""
    periods = version.partitions()
    if not periods:
        return None
    newest = version.read([periods[-1]]).agg(F.max("ordered_at")).first()[0]
    return newest - dt.timedelta(days=settings.lookback_days)


def load_orders(
    src: Sources,
    table: PublishedTable,
    settings: Settings,
    full_refresh: bool = False,
    run_log_path: str | None = None,
    started_at: dt.datetime | None = None,
    finished_at: dt.datetime | None = None,
    run_by: str | None = None,
    only_orders: DataFrame | None = None,
    run_id: str | None = None,
) -> None:
    """Build the order fact, or bring it up to date if it exists.

    An update takes in orders placed from 3 days (by default) before the newest
    one in the table. Later changes to older orders are not seen until a full
    refresh. With `only_orders` (raw orders, one row each) it takes in just these, of any age.

    A run with an id that has been published and logged isn't done again. One that was published and
    died before it was logged is logged by the next run, whatever its id.
    """
    run = audit.start_run(table.spark, "fct_orders", started_at, finished_at, run_by, run_id)
    version = table.latest()
    if run_log_path:
        audit.log_published(version, run_log_path)
        if run_id and audit.is_logged(table.spark, run_log_path, run_id):
            log.info("run %s has been logged before, so nothing is loaded", run_id)
            return
    rebuild = full_refresh or version is None
    since = None if rebuild else settings.start_date if only_orders is not None else watermark(version, settings)
    if not rebuild and since is None:
        rebuild = settings.empty_target == "full"
        if not rebuild:
            log.warning("the order fact is empty, so there is no watermark and nothing is loaded")

    def by_period(rows: DataFrame) -> DataFrame:
        return table.arrange(partition_by_period(rows, settings))

    def by_period_in_tasks(rows: DataFrame) -> DataFrame:
        # Items of an order stay together, as their common columns compress best so.
        return partition_by_period(rows, settings).sortWithinPartitions(ORDER_PARTITION, "order_id")

    ways = {"arrange": by_period, "arrange_large": by_period_in_tasks if settings.fact_partition == "month" else None}
    if rebuild:
        staged = table.stage(facts.fct_orders(src, settings, **ways), arranged=True)
        require_unique(staged.read(), facts.FCT_ORDERS_KEY)
        version = table.commit(version, [staged], staged.schema, run=run.as_manifest())
    elif since is not None:
        if only_orders is not None:
            src = src.replace(orders=conform(only_orders.withColumn("_loaded_at", F.lit(None)), ORDERS, "orders"))
        fact = facts.fct_orders(src, settings, since=since, **ways)
        recent = [p for p in version.partitions() if p >= since.strftime(_PERIOD[settings.fact_partition])]
        search = recent if settings.fixed_order_times and only_orders is None else None
        version = upsert(table, version, fact, facts.FCT_ORDERS_KEY, search, settings, run.as_manifest(), arranged=True)
    if run_log_path:
        audit.log_run(run, version, run_log_path)


def snapshot_sellers(src: Sources, table: PublishedTable, now: dt.datetime) -> None:
    """History of the raw sellers: their city is compared as stored, not upper-cased."""
    snapshot(table, src.sellers, "seller_id", SELLER_CHECK_COLUMNS, now)


def run(
    src: Sources,
    warehouse: Warehouse,
    settings: Settings,
    full_refresh: bool = False,
    threads: int = 4,
) -> None:
    """Register the staging views, rebuild dimensions and reviews, update the order fact.

    No table reads another one, so they are built at the same time: the small
    ones use the cluster while the large ones wait for their last tasks.
    """
    staging.create_views(src)
    calendar = dimensions.dim_date(warehouse.spark, settings)
    builds = {
        "dim_customers": lambda: dimensions.dim_customers(src),
        "dim_sellers": lambda: dimensions.dim_sellers(src),
        "dim_products": lambda: dimensions.dim_products(src, settings),
        "dim_date": lambda: calendar,
        "fct_reviews": lambda: facts.fct_reviews(src, settings),
    }
    with ThreadPoolExecutor(threads) as pool:
        jobs = [
            pool.submit(load_orders, src, warehouse.fct_orders, settings, full_refresh, warehouse.run_log_path)
        ]
        for name, build in builds.items():
            jobs.append(pool.submit(lambda n=name, b=build: warehouse.table(n).replace(b())))
        for job in jobs:
            job.result()


def load_seed(warehouse: Warehouse, csv_path: str | None = None) -> None:
    warehouse.seed.replace(exchange_rates(warehouse.spark, csv_path))


def run_quality_suite(
    src: Sources, warehouse: Warehouse, settings: Settings, now: dt.datetime | None = None
) -> DataFrame:
    """All declared checks, over the staging views and the written tables.

    Models that are not written are built with their checked columns only.
    """
    checked = {m: list(dict.fromkeys(c.column for c in CHECKS if c.model == m)) for m in _CHECKED_LAZILY}
    models = {name: model(src) for name, model in staging.MODELS.items()}
    models |= {
        "order_payments_summary": intermediate.order_payments_summary(src),
        "delivery_performance": intermediate.delivery_performance(src, checked["delivery_performance"]),
        "orders_joined": intermediate.orders_joined(src, settings, checked["orders_joined"]),
        "fct_orders": warehouse.fct_orders.read(),
    }
    for name in ("dim_customers", "dim_sellers", "dim_products", "dim_date", "fct_reviews"):
        models[name] = warehouse.table(name).read()
    return run_checks(CHECKS, models, now)
