
from __future__ import annotations

import datetime as dt
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries as oracle  # noqa: E402
from mercato import Settings, Sources  # noqa: E402
from mercato.functions import (  # noqa: E402
    cents_to_currency,
    current_timestamp_utc,
    ntz,
    safe_divide,
    surrogate_key,
)
from mercato.operators import quality  # noqa: E402
from mercato.operators.snapshot import history_table  # noqa: E402
from mercato.operators.upsert import upsert  # noqa: E402
from mercato.plans import dimensions, facts, intermediate, kpis, pipeline, staging  # noqa: E402
from mercato.session import work_dir  # noqa: E402
from mercato.sources.bucketed import write_bucketed  # noqa: E402
from mercato.sources.driver_tables import driver_sources  # noqa: E402
from mercato.sources.published import PublishedTable  # noqa: E402
from mercato.sources.seeds import exchange_rates  # noqa: E402

# The training-data operators are an optional part; an error inside them still shows.
HAS_LLM = bool(importlib.util.find_spec("mercato.llm")) and bool(
    importlib.util.find_spec("mercato.llm.registry")
)
if HAS_LLM:
    from mercato.llm import registry as llm  # noqa: E402
HAS_PIPELINE = HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None
if HAS_PIPELINE:
    import corpus_pipeline  # noqa: E402

SETTINGS = Settings()
# As if each batch had more keys than may be broadcast.
MANY_KEYS = Settings(broadcast_max_ids=0)

Query = Callable[[SparkSession, str], DataFrame]


def _at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _on_sources(model: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: model(driver_sources(spark, sf_dir))


def _on_orders(figure: Callable[[DataFrame], DataFrame], columns: list[str]) -> Query:
    """A figure over the order fact, built with just the columns it reads."""
    return _on_sources(lambda src: figure(facts.fct_orders(src, SETTINGS, columns=columns)))


def _on_reviews(figure: Callable[[DataFrame], DataFrame], columns: list[str]) -> Query:
    return _on_sources(lambda src: figure(facts.fct_reviews(src, SETTINGS, columns=columns)))


# ---- stateful queries: each call writes to a new folder


def _earlier(src: Sources) -> Sources:
    """The sources as an earlier load saw them: fewer orders, other prices, other dates."""
    bought = F.col("order_purchase_timestamp")
    orders = src.orders.filter(bought < ntz(_at(oracle.UPSERT_CUTOFF))).withColumn(
        "order_purchase_timestamp",
        F.when(F.col("order_status") == "canceled", bought - F.expr("interval 40 days")).otherwise(bought),
    )
    return src.replace(orders=orders, order_items=src.order_items.withColumn("price", F.col("price") + 1))


def _load_twice(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> pipeline.Warehouse:
    src = driver_sources(spark, sf_dir)
    warehouse = pipeline.Warehouse(spark, work_dir(spark, "orders"))
    for sources, (start, end) in ((_earlier(src), oracle.RUN_1), (src, oracle.RUN_2)):
        pipeline.load_orders(
            sources,
            warehouse.fct_orders,
            settings,
            run_log_path=warehouse.run_log_path,
            started_at=_at(start),
            finished_at=_at(end),
            run_by=oracle.RUN_BY,
        )
    return warehouse


def _audit_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with given times and user, and one with the clock's and the session's.

    The times of the third are unlike in each run: it shows whether they are in order and recent.
    """
    warehouse = _load_twice(spark, sf_dir)
    pipeline.load_orders(
        driver_sources(spark, sf_dir), warehouse.fct_orders, SETTINGS, run_log_path=warehouse.run_log_path
    )
    now = F.unix_seconds(F.current_timestamp())
    recent = (now - F.unix_seconds("run_started_at")).between(0, 3600) & (
        F.unix_seconds("run_finished_at") <= now + 1
    )
    own = F.col("run_by") == F.current_user()
    utc = {
        c: F.when(~recent, F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")))
        for c in ("run_started_at", "run_finished_at")
    }
    in_order = F.col("run_started_at") <= F.col("run_finished_at")
    return warehouse.run_log().select(
        "model_name",
        utc["run_started_at"].alias("run_started_at"),
        utc["run_finished_at"].alias("run_finished_at"),
        "rows_affected",
        F.when(~own, F.col("run_by")).alias("run_by"),
        in_order.alias("in_order"),
        recent.alias("is_recent"),
        own.alias("by_session_user"),
    )


def _audit_log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, and both repeated with other sources: they are neither published nor logged again."""
    src = driver_sources(spark, sf_dir)
    warehouse = pipeline.Warehouse(spark, work_dir(spark, "replay"))
    first, second = (_earlier(src), oracle.RUN_1, "feed/0"), (src, oracle.RUN_2, "feed/1")
    for sources, (start, end), run_id in (first, second, (_earlier(src), oracle.RUN_1, "feed/1"), first):
        pipeline.load_orders(
            sources,
            warehouse.fct_orders,
            SETTINGS,
            run_log_path=warehouse.run_log_path,
            started_at=_at(start),
            finished_at=_at(end),
            run_by=oracle.RUN_BY,
            run_id=run_id,
        )
    log = warehouse.run_log(with_run_id=True)
    for c in ("run_started_at", "run_finished_at"):
        log = log.withColumn(c, F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")))
    return log.withColumn("versions", F.lit(warehouse.fct_orders.latest().number))


def _schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old table without two of today's columns, with one more and one of another type."""
    summary = intermediate.order_payments_summary(driver_sources(spark, sf_dir))
    old = (
        summary.drop("payment_record_count", "voucher_value")
        .withColumn("legacy_flag", F.lit(True))
        .withColumn("max_installments", F.col("max_installments").cast("int"))
    )
    table = PublishedTable(spark, work_dir(spark, "payments"))
    first = table.replace(old)
    return upsert(table, first, summary.filter("max_installments >= 4"), "order_id").read()


def _scd2_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots; between them sellers appear, leave, change and move."""
    src = driver_sources(spark, sf_dir)
    state = F.col("seller_state")
    first = src.sellers.filter(state != "N3")
    second = src.sellers.filter(state != "N6").withColumns(
        {
            "seller_city": F.when(state.isin("N1", "N2"), F.upper("seller_city")).otherwise(
                F.col("seller_city")
            ),
            "seller_state": F.when(state != "N4", state),
            "seller_zip_code_prefix": F.when(state == "N5", "moved").otherwise(
                F.col("seller_zip_code_prefix")
            ),
        }
    )
    table = history_table(spark, work_dir(spark, "sellers"))
    pipeline.snapshot_sellers(src.replace(sellers=first), table, _at(oracle.HISTORY_1))
    pipeline.snapshot_sellers(src.replace(sellers=second), table, _at(oracle.HISTORY_2))
    return table.read()


def _built_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Sources, pipeline.Warehouse]:
    src = driver_sources(spark, sf_dir)
    warehouse = pipeline.Warehouse(spark, work_dir(spark, "warehouse"))
    pipeline.load_seed(warehouse, _seed_csv(spark))
    pipeline.run(src, warehouse, SETTINGS)
    return src, warehouse


def _orders_joined_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide frame over tables in buckets, no lookup being small enough to broadcast."""
    prefix = f"mercato_{uuid.uuid4().hex}"
    src = write_bucketed(driver_sources(spark, sf_dir), work_dir(spark, "buckets"), prefix, 16)
    return intermediate.orders_joined(src, Settings(broadcast_max_rows=0))


def _seed_csv(spark: SparkSession) -> str:
    """The rates as a CSV file with a header, as a user would keep them on shared storage."""
    path = work_dir(spark, "seed")
    exchange_rates(spark).coalesce(1).write.option("header", True).csv(path)
    return path


def _published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and a hash of the content of each written table and each staging view."""
    _, warehouse = _built_warehouse(spark, sf_dir)
    names = ("dim_customers", "dim_sellers", "dim_products", "dim_date", "fct_reviews")
    tables = {name: warehouse.table(name).read() for name in names}
    tables |= {"fct_orders": warehouse.fct_orders.read(), "exchange_rates": warehouse.seed.read()}
    tables |= {name: spark.table(name) for name in staging.MODELS}
    counts = [
        t.agg(F.count("*").alias("row_count"), F.sum(_row_hash(t)).alias("content_hash")).select(
            F.lit(name).alias("table_name"), "row_count", "content_hash"
        )
        for name, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _row_hash(table: DataFrame):
    """32 bits from the text forms of a row's columns in order of their names, the same on any engine."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    texts = []
    for name, kind in sorted((f.name, f.dataType.simpleString()) for f in table.schema.fields):
        c = F.col(name)
        if kind == "double":
            c = F.round(c * 100).cast("bigint")
        elif kind.startswith("decimal"):
            c = (c * 100).cast("bigint")
        elif kind == "timestamp_ntz":
            c = F.timestamp_diff("SECOND", epoch, c)
        texts.append(F.coalesce(c.cast("string"), F.lit("~")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("bigint")


def _dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, warehouse = _built_warehouse(spark, sf_dir)
    return pipeline.run_quality_suite(src, warehouse, SETTINGS, now=_at(oracle.FUTURE_AFTER))


# ---- function queries


def _fn_safe_divide(src: Sources) -> DataFrame:
    return intermediate.order_payments_summary(src).select(
        "order_id",
        "payment_record_count",
        "installment_payment_count",
        safe_divide("payment_record_count", "installment_payment_count").alias("payments_per_installment"),
    )


def _fn_cents_to_currency(src: Sources) -> DataFrame:
    cents = F.col("price") * 10
    return staging.order_items(src).select(
        "order_id",
        "order_item_id",
        cents.alias("price_cents"),
        cents_to_currency(cents).alias("price_amount"),
    )


def _fn_surrogate_key(src: Sources) -> DataFrame:
    return staging.reviews(src).select(
        "review_id",
        "order_id",
        surrogate_key("review_id", "order_id").alias("key_of_two"),
        surrogate_key("review_comment_title", "order_id").alias("key_with_null"),
        surrogate_key("review_score").alias("key_of_number"),
    )


def _fn_current_timestamp_utc(src: Sources) -> DataFrame:
    """Orders moved to within a day of now (by this machine's clock), so that a wrong zone shows."""
    clock = ntz(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    hours = F.hour("ordered_at") - 12
    moved = clock + F.make_dt_interval(hours=hours, mins=F.lit(30))
    now = current_timestamp_utc()
    return (
        staging.orders(src)
        .select("order_status", moved.alias("moved"))
        .groupBy("order_status")
        .agg(
            F.count(F.when(F.col("moved") <= now, 1)).alias("past_orders"),
            F.count(F.when(F.col("moved") > now, 1)).alias("future_orders"),
        )
    )


def entry(spark: SparkSession) -> DataFrame:
    """The order fact at sf0.001."""
    return queries()["fct_orders"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    orders_with = lambda columns: lambda src: facts.fct_orders(src, SETTINGS, columns=columns)
    return {
        **{name: _on_sources(model) for name, model in staging.MODELS.items()},
        "order_payments_summary": _on_sources(intermediate.order_payments_summary),
        "delivery_performance": _on_sources(intermediate.delivery_performance),
        "orders_joined_bucketed": _orders_joined_bucketed,
        "orders_joined": _on_sources(lambda src: intermediate.orders_joined(src, SETTINGS)),
        "fanout_guard": _on_sources(intermediate.fan_out_report),
        "dim_customers": _on_sources(dimensions.dim_customers),
        "dim_sellers": _on_sources(dimensions.dim_sellers),
        "dim_products": _on_sources(lambda src: dimensions.dim_products(src, SETTINGS)),
        "dim_date": _on_sources(lambda src: dimensions.calendar_usage(src, SETTINGS)),
        "fct_orders": _on_sources(lambda src: facts.fct_orders(src, SETTINGS)),
        "fct_reviews": _on_sources(lambda src: facts.fct_reviews(src, SETTINGS)),
        "seed_exchange_rates": lambda spark, sf_dir: kpis.rates_with_gmv(
            orders_with(kpis.GMV_COLUMNS)(driver_sources(spark, sf_dir)),
            exchange_rates(spark, _seed_csv(spark)),
            SETTINGS,
        ),
        "published_tables": _published_tables,
        "incremental_upsert_orders": lambda spark, sf_dir: _load_twice(spark, sf_dir).fct_orders.read(),
        "incremental_upsert_large_batch": lambda spark, sf_dir: _load_twice(
            spark, sf_dir, MANY_KEYS
        ).fct_orders.read(),
        "schema_sync": _schema_sync,
        "audit_run_log": _audit_run_log,
        "audit_log_replay": _audit_log_replay,
        "scd2_sellers": _scd2_sellers,
        "fn_safe_divide": _on_sources(_fn_safe_divide),
        "fn_cents_to_currency": _on_sources(_fn_cents_to_currency),
        "fn_surrogate_key": _on_sources(_fn_surrogate_key),
        "fn_current_timestamp_utc": _on_sources(_fn_current_timestamp_utc),
        "dq_unique": _on_sources(lambda src: quality.unique(staging.reviews(src), "review_id")),
        "dq_not_null": _on_sources(
            lambda src: quality.not_null(staging.products(src), "product_category_name")
        ),
        "dq_accepted_values": _on_sources(
            lambda src: quality.accepted_values(staging.reviews(src), "review_score", (1, 2, 3, 4, 5))
        ),
        "dq_relationships": _on_sources(
            lambda src: quality.relationships(
                staging.order_items(src), "order_id", staging.orders(src), "order_id", SETTINGS
            )
        ),
        "dq_no_future_dates": _on_orders(
            lambda f: quality.no_future_dates(f, "ordered_at", _at(oracle.FUTURE_AFTER)),
            ["order_item_key", "ordered_at"],
        ),
        "dq_positive_values": _on_orders(
            lambda f: quality.positive_values(f, "freight_value"), ["order_item_key", "freight_value"]
        ),
        "dq_valid_review_scores": _on_sources(
            lambda src: quality.valid_scores(facts.fct_reviews(src, SETTINGS))
        ),
        "dq_freshness": _on_sources(
            lambda src: quality.freshness(src.orders, "_loaded_at", _at(oracle.FRESH_AS_OF))
        ),
        "dq_suite": _dq_suite,
        "kpi_gmv": _on_orders(kpis.gmv, kpis.GMV_COLUMNS),
        "kpi_aov": _on_orders(kpis.average_order_value, kpis.AOV_COLUMNS),
        "kpi_on_time_rate": _on_orders(kpis.on_time_rate, kpis.ON_TIME_COLUMNS),
        "kpi_avg_delay": _on_orders(kpis.average_delay, kpis.DELAY_COLUMNS),
        "kpi_sla_breach_rate": _on_orders(kpis.sla_breach_rate, kpis.SLA_COLUMNS),
        "kpi_installment_rate": _on_orders(kpis.installment_rate, kpis.INSTALLMENT_COLUMNS),
        "kpi_avg_review": _on_reviews(kpis.average_review_score, kpis.AVG_REVIEW_COLUMNS),
        "kpi_late_negative_rate": _on_reviews(kpis.late_negative_rate, kpis.LATE_NEGATIVE_COLUMNS),
        "kpi_repeat_customer_rate": _on_orders(kpis.repeat_customer_rate, kpis.REPEAT_COLUMNS),
        "kpi_top_categories": _on_sources(
            lambda src: kpis.top_categories(
                orders_with(kpis.CATEGORY_COLUMNS)(src), dimensions.dim_products(src, SETTINGS)
            )
        ),
        "kpi_payment_mix": _on_orders(kpis.payment_mix, kpis.PAYMENT_MIX_COLUMNS),
        "kpi_gmv_usd": lambda spark, sf_dir: kpis.gmv_usd(
            orders_with(kpis.GMV_COLUMNS)(driver_sources(spark, sf_dir)), exchange_rates(spark), SETTINGS
        ),
        **(llm.QUERIES if HAS_LLM else {}),
        **({"pipeline": corpus_pipeline.run} if HAS_PIPELINE else {}),
    }


def oracle_sql() -> dict[str, str]:
    texts = oracle.oracle_texts()
    if HAS_LLM:
        texts |= llm.ORACLE_SQL
    if HAS_PIPELINE and corpus_pipeline.ORACLE_SQL is not None:
        texts["pipeline"] = corpus_pipeline.ORACLE_SQL
    return texts
