"""What the plans must look like on stored raw tables."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest

from mercato.plans import dimensions, facts, intermediate, kpis
from mercato.sources.raw import read_sources
from mercato.sources.schemas import RAW_TABLES


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    import __spark_entry__ as entry

    path = str(tmp_path_factory.mktemp("raw"))
    src = entry.driver_sources(spark, "/root/testdata/sf0.001")
    for t in RAW_TABLES:
        getattr(src, t).write.parquet(f"{path}/{t}")
    return read_sources(spark, path, names={t: t for t in RAW_TABLES})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return [line for line in plan(df).splitlines() if "FileScan" in line and f"/{table}]" in line]


def read_columns(df, table):
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    found = re.findall(rf"Location: [^\n]*/{table}\][\s\S]*?ReadSchema: struct<([^\n]*)>", text)
    return [{c.split(":")[0] for c in f.split(",")} for f in found]


def test_gmv_reads_only_what_it_needs(stored, settings):
    df = kpis.gmv(facts.fct_orders(stored, settings, columns=kpis.GMV_COLUMNS))
    assert read_columns(df, "order_items") == [{"order_id", "price", "freight_value"}]
    assert read_columns(df, "orders") == [{"order_id", "order_purchase_timestamp"}]
    for table in ("customers", "products", "sellers", "payments"):
        assert not scans(df, table)


def test_start_date_reaches_the_orders_scan(stored, settings):
    df = facts.fct_orders(stored, settings)
    assert all("order_purchase_timestamp#" in s and ">= 2016-01-01" in s for s in scans(df, "orders"))


def test_no_join_is_a_cross_join_and_no_python_runs(stored, settings):
    shuffled = replace(settings, broadcast_max_rows=0)
    for s in (settings, shuffled):
        for df in (
            facts.fct_orders(stored, s),
            facts.fct_reviews(stored, s),
            intermediate.orders_joined(stored, s),
            dimensions.dim_products(stored, s),
        ):
            text = plan(df)
            assert "Cartesian" not in text and "NestedLoop" not in text
            assert "Python" not in text and "InPandas" not in text


def test_payments_are_reduced_before_the_shuffle(stored):
    text = plan(intermediate.order_payments_summary(stored))
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum")
    assert text.count("Exchange hashpartitioning") == 1


def test_person_dedup_is_reduced_before_the_shuffle(stored):
    text = plan(dimensions.dim_customers(stored))
    assert re.search(r"Exchange hashpartitioning[\s\S]*WindowGroupLimit [^\n]*Partial", text)


def test_items_are_shuffled_once_with_small_lookups(spark, stored, settings):
    """Sellers and products are broadcast; the items meet their order in one shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, order_count = stored.order_items.count(), stored.orders.count()
        assert items > order_count > 200
        s = replace(settings, broadcast_max_rows=200)
        text = plan(facts.fct_orders(stored, s, columns=["seller_key", "product_key", "price"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 2


def exchanges_below(text, node):
    """Exchanges between the first `node` of a plan and the scan under it."""
    tree = text[text.index(node) :].splitlines()
    own = tree[: next(i for i, line in enumerate(tree) if "FileScan" in line) + 1]
    return [line for line in own if "Exchange hashpartitioning" in line]


@pytest.fixture
def no_broadcast(spark, settings):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield replace(settings, broadcast_max_rows=0, broadcast_max_ids=0)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_items_are_read_once_and_their_exchange_serves_the_deadlines(stored, no_broadcast):
    """Every lookup is above the limits: items are shuffled once per lookup, and deadlines cost no more."""
    df = facts.fct_orders(stored, no_broadcast)
    text = plan(df)
    assert len(scans(df, "order_items")) == 1
    assert text.count("Window ") == 1
    found = exchanges_below(text, "Window ")
    assert ["order_id", "product_id", "seller_id"] == [re.search(r"hashpartitioning\((\w+)#", x)[1] for x in found]
    # between the window and the join with the orders there is no further exchange or sort
    above = text[: text.index("Window ")].splitlines()[-3:]
    assert any("SortMergeJoin [order_id" in line for line in above)
    assert not any("Exchange" in line or "Sort [" in line for line in above)


def test_deadlines_of_hot_orders_are_reduced_first(stored, no_broadcast):
    """A hot order's items are salted for the join, so they never meet in one window."""
    df = facts.fct_orders(stored, replace(no_broadcast, hot_key_min_rows=2, hot_key_share=0.0))
    text = plan(df)
    assert "Window " not in text and "partial_min(shipping_limit" in text


@pytest.mark.parametrize("columns", [facts.FCT_ORDERS_COLUMNS, ["order_id", "price", "is_seller_sla_breach"]])
def test_both_ways_to_the_deadlines_agree(stored, settings, columns):
    def content(s):
        return sorted(map(str, facts.fct_orders(stored, s, columns=columns).collect()))

    one_exchange = content(replace(settings, broadcast_max_rows=10))
    assert one_exchange == content(settings)  # orders are broadcast
    assert one_exchange == content(replace(settings, broadcast_max_rows=10, hot_key_min_rows=2, hot_key_share=0.0))
