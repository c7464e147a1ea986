"""Scans of the raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.joins import KnownHotKeys
from mercato.sources.schemas import RAW_TABLES

# File or table names under which the raw tables are stored.
RAW_NAMES = {
    "customers": "CUSTOMERS",
    "orders": "ORDERS",
    "order_items": "ORDER_ITEMS",
    "products": "PRODUCTS",
    "payments": "PAYMENTS",
    "sellers": "SELLERS",
    "reviews": "REVIEWS",
    "geolocation": "GEOLOCATION",
    "category_translation": "PRODUCT_CATEGORY_TRANSLATION",
}


class Sources:
    """The raw tables, as lazy DataFrames. A table is opened when it is first asked for.

    `listings`, if known, holds all pairs of product and seller that items name (see `bucketed`).
    """

    def __init__(self, load: Callable[[str], DataFrame], listings: DataFrame | None = None):
        self._load = load
        self.listings = listings
        self._counts: dict[str, int] = {}
        self.hot_keys = KnownHotKeys()

    customers: DataFrame = cached_property(lambda self: self._load("customers"))
    orders: DataFrame = cached_property(lambda self: self._load("orders"))
    order_items: DataFrame = cached_property(lambda self: self._load("order_items"))
    products: DataFrame = cached_property(lambda self: self._load("products"))
    payments: DataFrame = cached_property(lambda self: self._load("payments"))
    sellers: DataFrame = cached_property(lambda self: self._load("sellers"))
    reviews: DataFrame = cached_property(lambda self: self._load("reviews"))
    geolocation: DataFrame = cached_property(lambda self: self._load("geolocation"))
    category_translation: DataFrame = cached_property(lambda self: self._load("category_translation"))

    def size(self, table: str) -> Callable[[], int]:
        """A function that returns the row count of a table, counted once."""

        def count() -> int:
            if table not in self._counts:
                self._counts[table] = getattr(self, table).count()
            return self._counts[table]

        return count

    def replace(self, **frames: DataFrame) -> Sources:
        """The same sources with some tables exchanged."""
        listings = None if "order_items" in frames else self.listings
        return Sources(lambda table: frames[table] if table in frames else getattr(self, table), listings)


def conform(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Select the declared columns with the declared types; extra columns are dropped.

    A missing column is an error here. (Passing a schema to the parquet reader
    would read it as NULL instead.)
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"raw table {name} lacks columns {missing}")
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if have[f.name.lower()].dataType == f.dataType
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_sources(
    spark: SparkSession, location: str, fmt: str = "parquet", names: dict[str, str] = RAW_NAMES, **options
) -> Sources:
    """Raw tables stored as `<location>/<name>` files, or as catalog tables with fmt="table".

    CSV files need a header line; pass `multiLine=True` if texts hold line breaks.
    """
    if fmt == "csv":
        options = {"header": True, "escape": '"', **options}

    def load(table: str) -> DataFrame:
        if fmt == "table":
            df = spark.table(f"{location}.{names[table]}")
        else:
            df = spark.read.format(fmt).options(**options).load(f"{location}/{names[table]}")
        return conform(df, RAW_TABLES[table], table)

    return Sources(load)
