"""The raw marketplace tables, derived from the order tables in `TESTDATA.md`.

Each raw table is a projection of one given table, kept whole: no join and no
window, so a query over it costs what the same query costs on stored raw tables.
The select lists are SQL text that Spark and DuckDB both read; the DuckDB side
of the correctness check uses them too. Irregular rows are made on purpose
(orphan items and payments, NULLs, bad scores, repeated review ids, late orders)
by giving some rows other values, never by dropping rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.raw import Sources, conform
from mercato.sources.schemas import RAW_TABLES

# The order dates, moved from 1995-2001 to 2015-2021 so that both ends of the
# calendar are exercised.
_DAY = "o_orderdate + interval '20' year"


def _after(hours: str) -> str:
    return f"{_DAY} + interval '1' hour * ({hours})"


_PURCHASE = "o_orderkey % 24"
_CARRIER = f"{_PURCHASE} + 24 * (o_orderkey % 7)"
_CUSTOMER = f"{_CARRIER} + 24 * (o_orderkey % 31)"


# A line is told apart by its values, not by its place within the order:
# numbering the lines of an order would sort each order in one task.
_LINE_ID = "0"
for _part, _range in [
    ("cast(round(l_extendedprice * 100) as bigint)", 1),
    ("l_linenumber", 10),
    ("cast(round(l_quantity) as bigint)", 100),
    ("cast(round(l_discount * 100) as bigint)", 100),
    ("cast(round(l_tax * 100) as bigint)", 10),
    ("l_partkey % 10000", 10000),
]:
    _LINE_ID = f"({_LINE_ID}) * {_range} + {_part}"


RAW_COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "'c' || cast(o_orderkey as string)",
        "customer_unique_id": "'u' || cast(o_custkey as string)",
        "customer_city": "'são josé ' || cast(o_orderkey % 50 as string)",
        "customer_state": "substr(o_orderpriority, 3, 2)",
        "customer_zip_code_prefix": "cast(o_orderkey % 100000 as string)",
    },
    "orders": {
        "order_id": "case when o_orderkey % 97 = 0 then 'x' else '' end || cast(o_orderkey as string)",
        "customer_id": "'c' || cast(o_orderkey as string)",
        "order_status": (
            "case when o_orderstatus = 'F' then 'delivered'"
            " when o_orderstatus = 'O' then 'shipped'"
            " when o_orderkey % 2 = 0 then 'canceled' else 'processing' end"
        ),
        "order_purchase_timestamp": _after(_PURCHASE),
        "order_approved_at": (
            f"case when o_orderkey % 53 <> 0 then {_after(_PURCHASE + ' + o_orderkey % 5')} end"
        ),
        "order_delivered_carrier_date": f"case when o_orderstatus <> 'P' then {_after(_CARRIER)} end",
        "order_delivered_customer_date": f"case when o_orderstatus = 'F' then {_after(_CUSTOMER)} end",
        "order_estimated_delivery_date": (
            f"case when o_orderkey % 101 <> 0 then {_DAY} + interval '20' day end"
        ),
        "_loaded_at": _after(_PURCHASE + " + 24"),
    },
    "order_items": {
        "order_id": "cast(l_orderkey as string)",
        "order_item_id": _LINE_ID,
        "product_id": "case when l_partkey % 67 = 0 then 'p' else '' end || cast(l_partkey as string)",
        "seller_id": "case when l_suppkey % 71 = 0 then 's' else '' end || cast(l_suppkey as string)",
        "shipping_limit_date": (
            "l_shipdate + interval '20' year + interval '1' hour * (l_partkey % 24)"
        ),
        "price": "l_extendedprice",
        "freight_value": "l_quantity - 2",
    },
    "products": {
        "product_id": "cast(p_partkey as string)",
        "product_category_name": "case when p_partkey % 40 <> 0 then lower(p_type) end",
        "product_name_lenght": "length(p_name)",
        "product_description_lenght": "10 * length(p_name)",
        "product_photos_qty": "p_partkey % 6",
        "product_weight_g": "p_size * 100",
        "product_length_cm": "case when p_partkey % 37 <> 0 then p_size * 100 end",
        "product_height_cm": "1000 * (p_partkey % 30 + 1)",
        "product_width_cm": "1000 * (p_partkey % 20 + 1)",
    },
    "payments": {
        "order_id": "case when o_orderkey % 89 = 0 then 'y' else '' end || cast(o_orderkey as string)",
        "payment_sequential": "n",
        "payment_type": (
            "case (o_orderkey + n) % 5 when 0 then 'credit_card' when 1 then 'boleto'"
            " when 2 then 'voucher' when 3 then 'debit_card' else 'not_defined' end"
        ),
        "payment_installments": "(o_orderkey + 3 * n) % 6",
        "payment_value": "case when n = 1 then o_totalprice else n * cast(10.25 as double) end",
    },
    "sellers": {
        "seller_id": "cast(s_suppkey as string)",
        "seller_city": "lower(s_name)",
        "seller_state": "'N' || cast(s_nationkey as string)",
        "seller_zip_code_prefix": "cast(s_suppkey as string)",
    },
    "reviews": {
        "review_id": "'r' || cast(o_orderkey - o_orderkey % 2 as string)",
        "order_id": "cast(o_orderkey as string)",
        "review_score": (
            "case when o_orderkey % 59 = 0 then null when o_orderkey % 83 = 0 then 6"
            " else 1 + (o_orderkey * 7) % 5 end"
        ),
        "review_comment_title": "cast(null as string)",
        "review_comment_message": "o_orderpriority",
        "review_creation_date": f"{_DAY} + interval '30' day",
        "review_answer_timestamp": f"{_DAY} + interval '32' day",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "cast(c_custkey % 50 as string)",
        "geolocation_lat": "c_nationkey * cast(1.5 as double) - 20",
        "geolocation_lng": "c_nationkey * cast(2.5 as double) - 60",
        "geolocation_city": "'são paulo ' || cast(c_nationkey as string)",
        "geolocation_state": "substr(c_mktsegment, 1, 2)",
    },
    # LARGE is translated under a name that no product has, so products keep the original one.
    "category_translation": {
        "product_category_name": "lower(p_type) || case when p_type = 'LARGE' then ' (old)' else '' end",
        "product_category_name_english": (
            "upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' EN'"
        ),
    },
}


def driver_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Raw tables over the parquet files in `sf_dir`."""

    @cache
    def given(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def base(table: str) -> DataFrame:
        if table == "order_items":
            return given("lineitem")
        if table == "products":
            return given("part")
        if table == "sellers":
            return given("supplier")
        if table == "geolocation":
            return given("customer")
        if table == "category_translation":
            return given("part").select("p_type").distinct()
        if table == "payments":
            # one to three payments per order, numbered by n
            numbers = F.sequence(F.lit(1), (1 + F.col("o_orderkey") % 3).cast("int"))
            return given("orders").withColumn("n", F.explode(numbers))
        return given("orders")

    def load(table: str) -> DataFrame:
        columns = [f"{e} as {c}" for c, e in RAW_COLUMNS[table].items()]
        return conform(base(table).selectExpr(*columns), RAW_TABLES[table], table)

    return Sources(load)


def duckdb_raw_tables() -> dict[str, str]:
    """The same tables as SELECT texts over DuckDB views of the given tables."""
    base = {
        "customers": "orders",
        "orders": "orders",
        "order_items": "lineitem",
        "products": "part",
        "payments": "orders cross join unnest(range(1, 2 + o_orderkey % 3)) as numbers(n)",
        "sellers": "supplier",
        "reviews": "orders",
        "geolocation": "customer",
        "category_translation": "(select distinct p_type from part) types",
    }
    texts = {}
    for table, columns in RAW_COLUMNS.items():
        types = {f.name: f.dataType.simpleString() for f in RAW_TABLES[table].fields}
        items = [
            f"cast({e} as {types[c].replace('timestamp_ntz', 'timestamp')}) as {c}"
            for c, e in columns.items()
        ]
        texts[table] = f"select {', '.join(items)} from {base[table]}"
    return texts
