"""What is shuffled and written by loads of the order fact, and that narrower ways give the same rows."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mercato.operators.joins import id_exceptions
from mercato.plans import facts, pipeline
from mercato.sources.published import PublishedTable

SINCE = dt.datetime(2018, 1, 1)


@pytest.fixture
def src(make_sources, order, item):
    """Orders of two years; products and sellers that are unknown, repeated or missing."""
    orders = [
        order(f"o{i}", order_purchase_timestamp=f"{2017 + (i % 3 == 0)}-0{1 + i % 9}-01 10:00:00") for i in range(30)
    ]
    items = [
        item(f"o{i}", n, product_id=(None, "p1", "p2", "gone")[(i + n) % 4], seller_id=("s1", "s2", "gone", None)[i % 4])
        for i in range(32)
        for n in (1, 2)
    ]
    return make_sources(
        orders=orders,
        order_items=items,
        payments=[{"order_id": f"o{i}", "payment_type": "boleto", "payment_value": 1.5} for i in range(31)],
        customers=[{"customer_id": f"c-o{i}", "customer_unique_id": f"u{i % 7}"} for i in range(0, 30, 2)],
        products=[{"product_id": p} for p in ("p1", "p2", "p2", "p3")],
        sellers=[{"seller_id": s} for s in ("s1", "s2", "s3", None)],
    )


def content(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_are_hashed_after_the_shuffle_by_period(spark, src, settings, tmp_path, monkeypatch):
    staged, stage = [], PublishedTable.stage
    monkeypatch.setattr(PublishedTable, "stage", lambda self, df, *a, **k: staged.append(plan(df)) or stage(self, df, *a, **k))
    one_each = src.replace(products=src.products.distinct())
    pipeline.load_orders(one_each, pipeline.Warehouse(spark, str(tmp_path)).fct_orders, settings)
    assert len(re.findall(r"REBALANCE_PARTITIONS_BY_COL", staged[0])) == 1
    above, below = re.split(r"Exchange [^\n]*REBALANCE_PARTITIONS_BY_COL", staged[0])
    hashed = [f"md5(cast(concat_ws(-, coalesce({c}#" for c in ("order_id", "customer_unique_id", "seller_id", "product_id")]
    assert all(h in above and h not in below for h in hashed)


def test_tables_are_stored_with_entropy_coding(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    assert all(f.endswith(".zstd.parquet") for f in table.replace(spark.range(9).toDF("id")).read().inputFiles())


@pytest.mark.parametrize("since", [None, SINCE])
@pytest.mark.parametrize("limits", [(2, 2), (4, 0), (0, 2), (0, 0), (0, 31)])
def test_ids_and_filter_instead_of_joins_give_the_same_rows(src, settings, no_auto_broadcast, since, limits):
    rows, ids = limits
    plain = content(facts.fct_orders(src, settings, since=since))
    assert plain
    assert content(facts.fct_orders(src, replace(settings, broadcast_max_rows=rows, broadcast_max_ids=ids), since=since)) == plain


def test_exceptions(spark, settings):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    ids = spark.createDataFrame([("a",), ("b",), ("b",), ("d",), ("d",), (None,)], "k string")
    found = id_exceptions(rows, ids, "k", "flag", settings)
    assert sorted(map(tuple, found.collect())) == [("b", True), ("b", True), ("c", False)]
    found.unpersist()
    assert id_exceptions(rows, ids, "k", "flag", replace(settings, broadcast_max_rows=2, broadcast_max_ids=0)) is None
    assert id_exceptions(rows, ids, "k", "flag", replace(settings, broadcast_max_rows=0, broadcast_max_ids=0)) is None


def test_items_are_not_shuffled_to_large_id_tables(src, settings, no_auto_broadcast):
    """Three products are more than may be broadcast, but only "gone" and "p2" are exceptions."""
    text = plan(facts.fct_orders(src, replace(settings, broadcast_max_rows=3, broadcast_max_ids=0)))
    way = re.search(r"Window [\s\S]*?Scan", text)[0]  # from the window to the items
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", way) == ["order_id"]
    assert way.count("BroadcastHashJoin") == 2


def test_large_update_filters_items_and_payments(src, settings, no_auto_broadcast):
    """Ten of 30 orders are more than may be broadcast: other orders' rows pass no shuffle."""
    df = facts.fct_orders(src, replace(settings, broadcast_max_rows=4, broadcast_max_ids=0), since=SINCE)
    assert plan(df).count("__bloom_block") >= 4 and "Window " in plan(df)
    assert df.select(F.min("ordered_at")).first()[0] >= SINCE


def arranged_plan(src, settings, arrange=lambda df: df.repartition("ordered_at")):
    df = facts.fct_orders(src, settings, arrange=arrange)
    return df, plan(df)


def test_load_filters_items_of_orders_that_are_not_there(src, settings, no_auto_broadcast):
    """Items name 32 orders. Where ten of them are there, other orders' items and payments pass no shuffle."""
    few = replace(settings, broadcast_max_rows=4, broadcast_max_ids=0)
    whole, text = arranged_plan(src, few)
    assert "__bloom_block" not in text
    some = src.replace(orders=src.orders.filter("order_id like 'o1%'"))
    df, text = arranged_plan(some, few)
    assert text.count("__bloom_block") >= 4 and "Window " in text
    assert content(df) == content(facts.fct_orders(some, settings))
    assert content(whole) == content(facts.fct_orders(src, settings))


@pytest.mark.parametrize("limits", [(100, 100), (3, 0), (0, 0)])
def test_metrics_and_flags_are_not_shuffled_to_periods(src, settings, no_auto_broadcast, limits):
    rows, ids = limits
    seen = []
    df, _ = arranged_plan(
        src, replace(settings, broadcast_max_rows=rows, broadcast_max_ids=ids), lambda rows: seen.append(rows) or rows
    )
    derived = {"delivery_delay_days", "is_on_time_delivery", "is_seller_sla_breach", "seller_processing_days"}
    assert not [c for c in seen[0].columns if c in derived or c.endswith(("_known", "_flag"))]
    assert content(df) == content(facts.fct_orders(src, settings))


@pytest.mark.parametrize("period", ["month", "day"])
def test_large_load_is_not_shuffled_to_months(spark, src, settings, no_auto_broadcast, tmp_path, monkeypatch, period):
    """Items that were shuffled to their orders are written from there, with the same rows in the same partitions."""
    staged, stage = [], PublishedTable.stage
    monkeypatch.setattr(PublishedTable, "stage", lambda self, df, *a, **k: staged.append(plan(df)) or stage(self, df, *a, **k))
    one_each = src.replace(products=src.products.distinct())
    few = replace(settings, broadcast_max_rows=0, broadcast_max_ids=100, fact_partition=period)
    earlier = one_each.replace(orders=src.orders.filter(F.col("order_purchase_timestamp") < F.lit(SINCE)))
    states = []
    for name, limit in (("gathered", 30), ("in_tasks", 0)):
        table = pipeline.Warehouse(spark, str(tmp_path / name)).fct_orders
        for load in (earlier, one_each):
            pipeline.load_orders(load, table, replace(few, gather_max_orders=limit))
        states.append(content(table.latest().read(with_partition=True)))
    assert states[0] == states[1] and len(states[0]) > 40
    shuffled = ["REBALANCE_PARTITIONS_BY_COL" in text for text in staged if "Window " in text]
    assert shuffled == [True, True, period == "day", period == "day"]
